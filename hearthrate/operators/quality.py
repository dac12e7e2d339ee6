"""Data-quality gate: all column checks read one shared aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hearthrate.functions.nulls import NUMERIC_TYPES, ratio
from hearthrate.operators.profile import column_stats

# Thresholds of the two gates and the bounds by column-name keyword.
NULL_FAIL_PCT = 50.0
NULL_WARN_PCT = 20.0
ROWS_FAIL = 100
ROWS_WARN = 1_000
CLASS_WARN_PCT = 5.0
CLASSES_NEEDED = 2
MAX_Z = 10.0
KEYWORD_BOUNDS = (
    ("count", 0, 1e12),
    ("rate", 0, 100),
    ("pct", 0, 100),
    ("percent", 0, 100),
    ("ratio", 0, 1),
    ("price", 0, 1e9),
    ("age", 0, 150),
    ("score", 0, 1e6),
    ("lat", -90, 90),
    ("lon", -180, 180),
    ("long", -180, 180),
)
REQUIRED_COLUMNS = (
    "price", "bedrooms", "accommodates", "bathrooms", "neighbourhood_cleansed", "room_type",
    "number_of_reviews", "latitude", "longitude",
)
STRICT_NULL_RATE = 0.40
STRICT_ROWS = 1_000

FINDING = "check string, column string, severity string, value double, message string"


def bounds_for(name: str, bounds: Sequence[tuple[str, float, float]] = KEYWORD_BOUNDS) -> tuple[float, float] | None:
    """Bounds of the first keyword the column name contains."""
    for keyword, low, high in bounds:
        if keyword in name.lower():
            return low, high
    return None


def _finding(check: str, column: Column, severity: Column, value: Column, message: Column) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        column.cast("string").alias("column"),
        severity.alias("severity"),
        value.cast("double").alias("value"),
        message.alias("message"),
    ]


def schema_findings(df: DataFrame, required: Mapping[str, str] | None) -> DataFrame:
    """Missing required columns fail; unexpected types warn. Reads the schema only."""
    rows = []
    if not required:
        rows.append(("schema", None, "warning", None, "no required schema given"))
    types = dict(df.dtypes)
    for name, wanted in (required or {}).items():
        if name not in types:
            rows.append(("schema", name, "failure", None, "required column is missing"))
        elif wanted and wanted not in types[name]:
            rows.append(("schema", name, "warning", None, f"expected {wanted}, found {types[name]}"))
    return df.sparkSession.createDataFrame(rows, FINDING)


def column_findings(
    df: DataFrame, bounds: Sequence[tuple[str, float, float]] = KEYWORD_BOUNDS
) -> DataFrame:
    """Row count, null rate, range, zero variance and extreme z-score in one pass over the data.

    The largest |z| needs no second pass: it sits at the minimum or the maximum.
    """
    stats = column_stats(df)
    name, rows = F.col("column"), F.col("rows")
    null_pct = ratio(F.col("missing"), rows) * 100
    low, high = F.lit(None).cast("double"), F.lit(None).cast("double")
    for column in df.columns:
        limits = bounds_for(column, bounds)
        if limits:
            low = F.when(name == column, F.lit(float(limits[0]))).otherwise(low)
            high = F.when(name == column, F.lit(float(limits[1]))).otherwise(high)
    far = F.greatest(F.col("max") - F.col("mean"), F.col("mean") - F.col("min"))
    z = F.when(F.col("std") > 0, ratio(far, F.col("std")))

    checks = F.array(
        F.struct(*_finding(
            "rows", F.lit(None),
            F.when(F.col("position") > 0, F.lit(None)).when(rows < ROWS_FAIL, "failure").when(rows < ROWS_WARN, "warning"),
            rows, F.lit("too few rows"))),
        F.struct(*_finding(
            "nulls", name,
            F.when(null_pct > NULL_FAIL_PCT, "failure").when(null_pct > NULL_WARN_PCT, "warning"),
            null_pct, F.lit("null rate"))),
        F.struct(*_finding(
            "range", name, F.when((F.col("min") < low) | (F.col("max") > high), "warning"),
            F.when(F.col("min") < low, F.col("min")).otherwise(F.col("max")), F.lit("value outside its bounds"))),
        F.struct(*_finding(
            "variance", name, F.when((F.col("filled") >= 2) & (F.col("std") == 0), "warning"),
            F.col("mean"), F.lit("constant column"))),
        F.struct(*_finding(
            "outliers", name, F.when((F.col("filled") >= 2) & (z > MAX_Z), "warning"),
            z, F.lit("largest |z|"))),
    )
    return stats.select(F.explode(checks).alias("f")).select("f.*").where(F.col("severity").isNotNull())


def class_table(df: DataFrame, target: str) -> DataFrame:
    """(class, n, pct, below_min): every class of the target with its share; NULL is a class."""
    counts = df.groupBy(F.col(target).cast("string").alias("class")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)))
    pct = ratio(F.col("n"), total.scalar()) * 100
    return counts.select("class", "n", pct.alias("pct"), (pct < CLASS_WARN_PCT).cast("int").alias("below_min"))


def target_findings(df: DataFrame, target: str | None) -> DataFrame:
    """Too few classes fail; rare classes warn as one line, so a continuous target stays readable."""
    if target is None:
        return df.sparkSession.createDataFrame([("target", None, "warning", None, "no target given")], FINDING)
    if target not in df.columns:
        return df.sparkSession.createDataFrame([("target", target, "failure", None, "target is missing")], FINDING)
    classes = class_table(df, target).agg(
        F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum("below_min"), F.lit(0)).alias("rare")
    )
    few = F.col("classes") < CLASSES_NEEDED
    checks = F.array(
        F.struct(*_finding("target", F.lit(target), F.when(few, "failure"), F.col("classes"), F.lit("too few classes"))),
        F.struct(*_finding(
            "target", F.lit(target), F.when(~few & (F.col("rare") > 0), "warning"), F.col("rare"),
            F.lit("classes below the minimum share"))),
    )
    return classes.select(F.explode(checks).alias("f")).select("f.*").where(F.col("severity").isNotNull())


def quality_report(
    df: DataFrame,
    required: Mapping[str, str] | None = None,
    target: str | None = None,
    bounds: Sequence[tuple[str, float, float]] = KEYWORD_BOUNDS,
) -> DataFrame:
    """All findings of the gate, one row each."""
    parts = [schema_findings(df, required), column_findings(df, bounds), target_findings(df, target)]
    return reduce(DataFrame.unionByName, parts)


def gate_verdict(report: DataFrame) -> DataFrame:
    """One row: passed, failures, warnings."""
    failures = F.count(F.when(F.col("severity") == "failure", 1))
    return report.agg(
        failures.alias("failures"), F.count(F.when(F.col("severity") == "warning", 1)).alias("warnings")
    ).select((F.col("failures") == 0).cast("int").alias("passed"), "failures", "warnings")


def table_statistics(df: DataFrame) -> DataFrame:
    """Rows, columns, numeric columns and null cells of a table."""
    return column_stats(df).agg(
        F.max("rows").alias("rows"),
        F.count(F.lit(1)).alias("columns"),
        F.count(F.when(F.col("is_numeric"), 1)).alias("numeric_columns"),
        F.sum("missing").alias("null_cells"),
    )


def gate_measures(df: DataFrame) -> list[Column]:
    """What the strict gate needs of a table's rows: their number, and the missing cells of each column."""
    missing = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"missing_{i}") for i, c in enumerate(df.columns)]
    return [F.count(F.lit(1)).alias("rows"), *missing]


def gate_from_measures(
    df: DataFrame,
    measures: Mapping[str, int],
    required: Sequence[str] = REQUIRED_COLUMNS,
    target: str = "price",
    min_rows: int = STRICT_ROWS,
    max_null_rate: float = STRICT_NULL_RATE,
) -> DataFrame:
    """The failures ``strict_gate`` finds, from measures observed while the table was computed: no scan."""
    found = [("missing_column", c) for c in required if c not in df.columns]
    numeric = target in df.columns and isinstance(df.schema[target].dataType, NUMERIC_TYPES)
    if target in df.columns and not numeric:
        found.append(("target_not_numeric", target))
    rows = measures["rows"]
    if rows < min_rows:
        found.append(("too_few_rows", str(rows)))
    for i, column in enumerate(df.columns):
        missing = measures[f"missing_{i}"]
        if column == target and numeric and missing:
            found.append(("target_has_nulls", column))
        if rows and missing / rows > max_null_rate:
            found.append(("null_rate", column))
    return df.sparkSession.createDataFrame(found, "check string, detail string")


def strict_gate(
    df: DataFrame,
    required: Sequence[str] = REQUIRED_COLUMNS,
    target: str = "price",
    min_rows: int = STRICT_ROWS,
    max_null_rate: float = STRICT_NULL_RATE,
) -> DataFrame:
    """(check, detail): failures of the strict gate; no rows means it passed."""
    plan_time = [("missing_column", c) for c in required if c not in df.columns]
    numeric_target = target in df.columns and isinstance(df.schema[target].dataType, NUMERIC_TYPES)
    if target in df.columns and not numeric_target:
        plan_time.append(("target_not_numeric", target))
    stats = column_stats(df)
    rows, rate = F.col("rows"), ratio(F.col("missing"), F.col("rows"))
    checks = F.array(
        F.struct(
            F.when((F.col("position") == 0) & (rows < min_rows), "too_few_rows").alias("check"),
            rows.cast("string").alias("detail")),
        F.struct(
            F.when((F.col("column") == target) & F.lit(numeric_target) & (F.col("missing") > 0), "target_has_nulls")
            .alias("check"), F.col("column").alias("detail")),
        F.struct(F.when(rate > max_null_rate, "null_rate").alias("check"), F.col("column").alias("detail")),
    )
    measured = stats.select(F.explode(checks).alias("f")).select("f.*").where(F.col("check").isNotNull())
    return df.sparkSession.createDataFrame(plan_time, "check string, detail string").unionByName(measured)
