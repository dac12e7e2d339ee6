"""Feature selection and leakage checks. Statistics are distributed; the choice is over column names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from hearthrate.functions.nulls import numeric_columns
from hearthrate.operators.profile import column_stats, correlation_matrix, target_correlations

# Selection thresholds, columns never filtered, and leakage bounds.
CORRELATION_LIMIT = 0.95
VARIANCE_FRACTION = 0.01
ALWAYS_KEEP = ("latitude", "longitude", "neighbourhood_group_avg_price")
LEAKAGE_RISK = 0.70
LEAKAGE_WARNING = 0.50


@dataclass
class Selection:
    """Chosen features, the columns to output, and the drop log: feature → (reason, other feature, value)."""

    selected: list[str]
    columns: list[str]
    dropped: dict[str, tuple[str, str | None, float]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*self.columns)

    def report(self, df: DataFrame) -> DataFrame:
        """(feature, reason, other, value) of every dropped feature."""
        rows = [(feature, *why) for feature, why in self.dropped.items()]
        return df.sparkSession.createDataFrame(rows, "feature string, reason string, other string, value double")


def _near_constant(df: DataFrame, columns: Sequence[str], fraction: float) -> dict[str, float]:
    """Columns whose variance is below ``fraction`` of the median variance, with their variance."""
    if not columns:
        return {}
    spread = column_stats(df, columns).where(F.col("variance").isNotNull()).select("column", "variance")
    bound = spread.agg(F.percentile("variance", 0.5) * fraction)
    return {row["column"]: row["variance"] for row in spread.where(F.col("variance") < bound.scalar()).collect()}


def _strong_partners(df: DataFrame, columns: Sequence[str], limit: float) -> dict[str, dict[str, float]]:
    """For each column the earlier ones it is correlated with above the limit; only those pairs leave Spark."""
    partners: dict[str, dict[str, float]] = {}
    if len(columns) > 1:
        strong = correlation_matrix(df, columns).where((F.col("a") != F.col("b")) & (F.abs("r") > limit) & ~F.isnan("r"))
        for row in strong.select("a", "b", F.abs("r").alias("r")).collect():
            partners.setdefault(row["b"], {})[row["a"]] = row["r"]
    return partners


def select_features(
    df: DataFrame,
    target: str = "price",
    key: str = "id",
    always_keep: Sequence[str] = ALWAYS_KEEP,
    correlation_limit: float = CORRELATION_LIMIT,
    variance_fraction: float = VARIANCE_FRACTION,
) -> Selection:
    """Leave out near-constant numeric columns, and each column too close to an earlier one that stays."""
    numeric = numeric_columns(df)
    judged = [c for c in numeric if c not in {target, key, *always_keep}]
    flat = _near_constant(df, judged, variance_fraction)
    dropped: dict[str, tuple[str, str | None, float]] = {c: ("low_variance", None, flat[c]) for c in judged if c in flat}
    partners = _strong_partners(df, [c for c in judged if c not in flat], correlation_limit)
    staying: dict[str, None] = {}
    for column in (c for c in judged if c not in flat):
        near = partners.get(column, {})
        rival = next((c for c in staying if c in near), None)
        if rival is None:
            staying[column] = None
        else:
            dropped[column] = ("correlated", rival, round(near[rival], 4))
    return Selection(
        selected=[c for c in numeric if c in always_keep] + list(staying),
        columns=[c for c in df.columns if c not in dropped],
        dropped=dropped,
    )


def leakage_flags(df: DataFrame, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, abs_r, verdict): features suspiciously correlated with the target."""
    strength = F.abs("r")
    verdict = F.when(strength >= LEAKAGE_RISK, "risk").when(strength >= LEAKAGE_WARNING, "warning").otherwise("ok")
    return target_correlations(df, target, columns).select("column", strength.alias("abs_r"), verdict.alias("verdict"))
