"""Design matrix as fit and transform: categories and medians come from the training rows only."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from hearthrate.functions.nulls import number, numeric_columns
from hearthrate.functions.pricing import log_price
from hearthrate.operators.quantiles import column_medians, quantile_table
from hearthrate.operators.skew import lookup_join

# Categories kept per column, columns left out of the model, and columns encoded.
TOP_CATEGORIES = {
    "property_type": 10,
    "host_response_rate": 10,
    "host_acceptance_rate": 10,
    "bathrooms_text": 10,
    "host_verifications": 6,
}
LEFT_OUT = (
    "host_name", "host_since", "host_location", "host_neighbourhood", "amenities", "has_availability",
    "neighbourhood_cleansed", "neighbourhood_group_cleansed",
)
ENCODED = (
    "neighbourhood_group", "room_type", "host_response_time", "host_is_superhost", "host_response_rate",
    "host_acceptance_rate", "property_type", "instant_bookable", "host_has_profile_pic",
    "host_identity_verified", "host_verifications", "bathrooms_text",
)
OTHER = "Other"


def top_categories(df: DataFrame, column: str, top: int) -> list[str]:
    """The most frequent values; ties go to the smaller value."""
    ranked = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(top)
    )
    return [row[column] for row in ranked.collect()]


def bucket_categories(column: Column, kept: Sequence[str]) -> Column:
    """Values outside the kept ones, and NULL, become "Other"."""
    return F.when(column.isin(list(kept)), column).otherwise(F.lit(OTHER))


def categories_of(df: DataFrame, column: Column, limit: int | None = None) -> list[str]:
    """Sorted distinct values; more than the caller's ``limit`` are an error rather than a silent cut."""
    values = df.select(column.cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
    rows = (values if limit is None else values.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} categories to encode")
    return sorted(row["v"] for row in rows)


def one_hot(column: Column, name: str, categories: Sequence[str]) -> list[Column]:
    """0/1 columns for all but the first category; NULL and unseen values are all zero."""
    text = column.cast("string")
    return [F.coalesce((text == c).cast("int"), F.lit(0)).alias(f"{name}_{c}") for c in categories[1:]]


@dataclass
class DesignMatrix:
    """Fitted encoding: kept categories, one-hot categories, numeric columns and their medians."""

    key: str = "id"
    target: str = "price"
    kept: dict[str, list[str]] = field(default_factory=dict)
    encoded: dict[str, list[str]] = field(default_factory=dict)
    numeric: list[str] = field(default_factory=list)
    medians: dict[str, float] = field(default_factory=dict)
    features: list[str] = field(default_factory=list)

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        key: str = "id",
        target: str = "price",
        left_out: Sequence[str] = LEFT_OUT,
        top: Mapping[str, int] = TOP_CATEGORIES,
        encode: Sequence[str] = ENCODED,
        limit: int | None = None,
    ) -> "DesignMatrix":
        """Learn everything from ``df``. The key never becomes a feature.

        ``limit``: the most categories an encoded column may have, if there is a limit.
        """
        slim = df.drop(*left_out)
        fitted = cls(key=key, target=target)
        for name, size in top.items():
            if name in slim.columns:
                fitted.kept[name] = top_categories(slim, name, size)
        for name in encode:
            if name in slim.columns:
                fitted.encoded[name] = categories_of(slim, fitted._category(name), limit)
        fitted.numeric = [c for c in numeric_columns(slim) if c not in (key, target) and c not in fitted.encoded]
        fitted.medians = column_medians(slim, fitted.numeric)
        fitted.features = fitted.numeric + [f"{n}_{c}" for n, cs in fitted.encoded.items() for c in cs[1:]]
        return fitted

    def _category(self, name: str) -> Column:
        return bucket_categories(F.col(name), self.kept[name]) if name in self.kept else F.col(name)

    def transform(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """Key, carried columns, label (log target, if present) and every feature in fitted order.

        A fitted column the input lacks is filled: its median for a number, 0 for
        an encoded category.
        """
        out: list[Column] = [F.col(c) for c in (self.key, *carry) if c in df.columns]
        if self.target in df.columns:
            out.append(log_price(number(df, self.target)).alias("label"))
        for name in self.numeric:
            fallback = F.lit(self.medians.get(name)).cast("double")
            out.append(F.coalesce(number(df, name), fallback).alias(name) if name in df.columns else fallback.alias(name))
        for name, categories in self.encoded.items():
            source = self._category(name) if name in df.columns else F.lit(None).cast("string")
            out += one_hot(source, name, categories)
        return df.select(*out)

    def assemble(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """Key, carried columns, label and the feature vector."""
        wide = self.transform(df, carry)
        return assemble_vector(wide, self.features).drop(*self.features)

    def defaults(self, df: DataFrame) -> dict[str, float]:
        """Median of every design column, the starting row for scenarios."""
        wide = self.transform(df)
        return column_medians(wide, self.features)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "DesignMatrix":
        return cls(**json.loads(text))


def assemble_vector(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def align_columns(df: DataFrame, columns: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """Exactly the trained columns in trained order: absent ones are 0, others are dropped."""
    return df.select(
        *carry, *[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in columns]
    )


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean 0 and population standard deviation 1; constant columns become 0."""
    stats = df.agg(
        *[F.avg(number(df, c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(number(df, c)).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    changes = {}
    for i, c in enumerate(columns):
        spread = stats[f"s{i}"] or 1.0
        changes[c] = (number(df, c) - F.lit(stats[f"m{i}"])) / F.lit(spread)
    return df.withColumns(changes)


def area_medians(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Medians per area, named like the columns themselves."""
    table = quantile_table(df, columns, [0.5], [group])
    return table.groupBy(group).agg(*[
        F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in columns
    ])


def scenario_rows(
    scenarios: DataFrame,
    defaults: Mapping[str, float],
    areas: DataFrame,
    area: str,
    category_columns: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Complete feature rows from partial scenarios.

    A feature is the scenario's own value, else the area's median, else the
    default. ``category_columns`` maps a scenario column to its categories; their
    one-hot columns are set from the scenario and never from defaults.
    """
    hot = {f"{name}_{c}" for name, cs in category_columns.items() for c in cs[1:]}
    area_values = {c: f"_area_{c}" for c in areas.columns if c != area}
    renamed = areas.select(area, *[F.col(c).alias(alias) for c, alias in area_values.items()])
    joined = lookup_join(scenarios, renamed, [area])
    out: list[Column] = [F.col(c) for c in scenarios.columns if c not in defaults]
    for name, default in defaults.items():
        if name in hot:
            continue
        options = []
        if name in scenarios.columns:
            options.append(F.col(name).cast("double"))
        if name in area_values:
            options.append(F.col(area_values[name]))
        out.append(F.coalesce(*options, F.lit(float(default))).alias(name))
    for name, categories in category_columns.items():
        out += one_hot(F.col(name), name, categories)
    return joined.select(*out)


def fold_ends(df: DataFrame, key: str, folds: int) -> list[float]:
    """Bounds between contiguous folds, each halfway between the two keys it separates."""
    total = df.count()
    ends, reached = [], 0
    for i in range(folds - 1):
        reached += total // folds + (1 if i < total % folds else 0)
        ends.append(reached)
    if total < 2:
        return []
    # Half a rank past the last row of a fold: rounding in the product cannot move a row.
    probs = [min(1.0, max(0.0, (end - 0.5) / (total - 1))) for end in ends]
    return list(quantile_table(df, [key], probs).first()["q"])


def contiguous_folds(df: DataFrame, key: str, folds: int, out: str = "fold") -> DataFrame:
    """Fold numbers along the order of an integer key, as equal in size as possible."""
    chain = F.lit(folds - 1)
    for fold, last in reversed(list(enumerate(fold_ends(df, key, folds)))):
        chain = F.when(F.col(key) <= last, fold).otherwise(chain)
    return df.withColumn(out, chain)
