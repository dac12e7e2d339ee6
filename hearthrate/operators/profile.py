"""Profiling: counts, summaries, missing values, coverage and correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hearthrate.functions.keyed import key_digest
from hearthrate.functions.nulls import corrected_skew, guarded_corr, number, numeric_columns, present, ratio
from hearthrate.operators.quantiles import quantile_table

# Columns and pairs per aggregate: wider ones leave the compiled path.
COLUMN_CHUNK = 60
PAIR_CHUNK = 120


def _chunks(items: Sequence, size: int) -> list[Sequence]:
    return [items[i : i + size] for i in range(0, len(items), size)]


def _stack(df: DataFrame, cells: list[list[Column]]) -> DataFrame:
    """A one-row aggregate as one row per cell."""
    return df.select(F.explode(F.array(*[F.struct(*cell) for cell in cells])).alias("cell")).select("cell.*")


def column_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column from one pass: rows, missing, and for numbers min/max/mean/std/variance.

    Standard deviation and variance are the sample forms.
    """
    names = list(columns) if columns is not None else df.columns
    numeric = set(numeric_columns(df))
    parts = []
    for chunk in _chunks(names, COLUMN_CHUNK):
        aggregates, cells = [F.count(F.lit(1)).alias("rows")], []
        for i, name in enumerate(chunk):
            aggregates.append(F.count(F.when(present(df, name), 1)).alias(f"n{i}"))
            if name in numeric:
                value = number(df, name)
                aggregates += [
                    F.min(value).alias(f"lo{i}"),
                    F.max(value).alias(f"hi{i}"),
                    F.avg(value).alias(f"mean{i}"),
                    F.stddev_samp(value).alias(f"std{i}"),
                    F.var_samp(value).alias(f"var{i}"),
                ]
            blank = F.lit(None).cast("double")

            def stat(stem: str) -> Column:
                return F.col(f"{stem}{i}") if name in numeric else blank

            cells.append([
                F.lit(name).alias("column"),
                F.lit(name in numeric).alias("is_numeric"),
                F.lit(df.columns.index(name)).alias("position"),
                F.col("rows").alias("rows"),
                F.col(f"n{i}").alias("filled"),
                (F.col("rows") - F.col(f"n{i}")).alias("missing"),
                stat("lo").alias("min"),
                stat("hi").alias("max"),
                stat("mean").alias("mean"),
                stat("std").alias("std"),
                stat("var").alias("variance"),
            ])
        parts.append(_stack(df.agg(*aggregates), cells))
    return reduce(DataFrame.unionByName, parts)


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, most missing first; percentage to two decimals."""
    stats = column_stats(df, columns).where(F.col("missing") > 0)
    return stats.select(
        "column", "missing", F.round(ratio(F.col("missing"), F.col("rows")) * 100, 2).alias("pct")
    ).orderBy(F.desc("missing"), "column")


def missing_totals(df: DataFrame) -> DataFrame:
    """Missing cells and the number of columns that have any."""
    stats = column_stats(df)
    return stats.agg(
        F.sum("missing").alias("missing_cells"), F.count(F.when(F.col("missing") > 0, 1)).alias("columns_with_missing")
    )


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    stats = column_stats(df, columns or numeric_columns(df))
    return stats.select("column", "mean", "std", "min", "max")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, exact quartiles and max per numeric column."""
    names = list(columns or numeric_columns(df))
    quartiles = quantile_table(df, names, [0.25, 0.5, 0.75])
    quartiles = quartiles.select("column", *[F.col("q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))])
    stats = column_stats(df, names).select("column", F.col("filled").alias("count"), "mean", "std", "min", "max")
    return stats.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """The target on its raw and log scales: mean, median, std, min, quartiles, max, skew."""
    scales = df.select(number(df, target).alias("raw")).withColumn("log", F.when(F.col("raw") > 0, F.ln("raw")))
    moments = scales.agg(
        *[corrected_skew(F.col(c)).alias(f"skew_{c}") for c in ("raw", "log")]
    )
    skews = _stack(moments, [[F.lit(c).alias("column"), F.col(f"skew_{c}").alias("skew")] for c in ("raw", "log")])
    table = describe_numeric(scales).join(skews, "column")
    return table.select(
        F.col("column").alias("scale"), "mean", F.col("p50").alias("median"), "std", "min", "p25", "p75", "max", "skew"
    )


def coverage_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled count and share, min, median and max per feature."""
    medians = quantile_table(df, list(columns), [0.5]).select("column", F.col("q")[0].alias("median"))
    stats = column_stats(df, columns)
    return stats.join(medians, "column", "left").select(
        "column",
        "filled",
        (ratio(F.col("filled"), F.col("rows")) * 100).alias("pct"),
        "min",
        "median",
        "max",
    )


def flag_coverage(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """How many rows carry each 0/1 flag, and the percentage."""
    parts = []
    for chunk in _chunks(list(flags), COLUMN_CHUNK):
        sums = df.agg(
            F.count(F.lit(1)).alias("rows"), *[F.sum(F.col(name).cast("long")).alias(f"s_{name}") for name in chunk]
        )
        parts.append(_stack(sums, [
            [
                F.lit(name).alias("flag"),
                F.coalesce(F.col(f"s_{name}"), F.lit(0)).alias("rows_set"),
                (ratio(F.col(f"s_{name}"), F.col("rows")) * 100).alias("pct"),
            ]
            for name in chunk
        ]))
    return reduce(DataFrame.unionByName, parts)


def correlation_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(a, b, r) for the listed column pairs, pairwise complete."""
    parts = []
    for chunk in _chunks(list(pairs), PAIR_CHUNK):
        sums = df.agg(*[
            guarded_corr(number(df, a), number(df, b)).alias(f"r{i}") for i, (a, b) in enumerate(chunk)
        ])
        parts.append(_stack(sums, [
            [F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r")] for i, (a, b) in enumerate(chunk)
        ]))
    if not parts:
        schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()),
                               T.StructField("r", T.DoubleType())])
        return df.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def target_correlations(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, r, direction) by falling absolute correlation with the target."""
    names = [c for c in (columns or numeric_columns(df)) if c != target]
    return (
        correlation_pairs(df, [(c, target) for c in names])
        .select(
            F.col("a").alias("column"),
            "r",
            F.when(F.col("r") > 0, "higher").when(F.col("r").isNotNull(), "lower").alias("direction"),
        )
        .orderBy(F.abs("r").desc_nulls_last(), "column")
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Upper triangle with diagonal, long form (a, b, r)."""
    names = list(columns)
    return correlation_pairs(df, [(a, b) for i, a in enumerate(names) for b in names[i:]])


def top_correlated_matrix(
    df: DataFrame, target: str, top: int = 20, exclude: Sequence[str] = ()
) -> DataFrame:
    """Correlation matrix of the features most correlated with the target."""
    names = [c for c in numeric_columns(df, exclude) if c != target]
    best = target_correlations(df, target, names).where(F.col("r").isNotNull()).limit(top).collect()
    return correlation_matrix(df, [row["column"] for row in best])


def keyed_sample(df: DataFrame, key: str, rows: int, seed: int = 42) -> DataFrame:
    """A reproducible sample: the rows whose key hashes lowest."""
    return df.orderBy(key_digest(F.col(key), seed), key).limit(rows)


def null_matrix(df: DataFrame, key: str, rows: int = 300, seed: int = 42) -> DataFrame:
    """0/1 missing indicators on a keyed sample of rows."""
    indicators = [(~present(df, c)).cast("int").alias(c) for c in df.columns if c != key]
    return keyed_sample(df, key, rows, seed).select(key, *indicators)


def sentiment_summary(df: DataFrame, score: str) -> DataFrame:
    """Mean, median and positive/negative percentages over rows that have a score other than 0."""
    scored = df.where(number(df, score) != 0)
    value = F.col(score)
    median = quantile_table(scored, [score], [0.5]).select(F.col("q")[0]).limit(1)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(value).alias("mean"),
        (F.avg((value > 0.05).cast("double")) * 100).alias("pct_positive"),
        (F.avg((value < -0.05).cast("double")) * 100).alias("pct_negative"),
    ).withColumn("median", median.scalar())


def inspect(df: DataFrame) -> dict[str, DataFrame]:
    """Shape, numeric summary and missing values of a table."""
    return {"shape": table_shape(df), "summary": numeric_summary(df), "missing": missing_report(df)}
