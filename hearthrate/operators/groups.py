"""Group statistics, dimension joins, distributions and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from hearthrate.functions.nulls import number, ratio
from hearthrate.operators.quantiles import group_quantiles, quantile_table
from hearthrate.operators.skew import lookup_join, sized

# The sample size below which a group median is marked, and the note.
SMALL_SAMPLE = 10
SMALL_SAMPLE_NOTE = "Note: small sample size may affect median"
WHISKER = 1.5


def require_unique(side: DataFrame, keys: Sequence[str]) -> None:
    """Fail if a join side repeats a key: a left join would then multiply rows."""
    repeated = side.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).limit(1).collect()
    if repeated:
        raise ValueError(f"join side is not unique on {list(keys)}")


def attach_dimension(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join a dimension whose key was checked to be unique."""
    require_unique(dimension, keys)
    return lookup_join(facts, dimension, keys)


def attach_group_mean(
    df: DataFrame, group: str, value: str, out: str, exclude_self: bool = False
) -> DataFrame:
    """Mean of the group on every row; NULL for rows without a group.

    The mean is aggregated and joined rather than windowed, so a group with a
    large part of the rows is never gathered. ``exclude_self`` leaves the row's
    own value out of its mean.
    """
    measured = number(df, value)
    means = (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.sum(measured).alias("_total"), F.count(measured).alias("_n"))
    )
    joined = lookup_join(df, means, [group])
    own = F.coalesce(measured, F.lit(0.0))
    if exclude_self:
        mean = ratio(F.col("_total") - own, F.col("_n") - measured.isNotNull().cast("int"))
    else:
        mean = ratio(F.col("_total"), F.col("_n"))
    return joined.withColumn(out, mean).select(*df.columns, out)


def group_medians(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Median of several columns per group, wide."""
    table = quantile_table(df, columns, [0.5], [group])
    middle = F.col("q")[0]
    return table.groupBy(group).agg(*[
        F.max(F.when(F.col("column") == c, middle)).alias(f"median_{c}") for c in columns
    ])


def group_price_table(df: DataFrame, group: str, value: str) -> DataFrame:
    """Median and count per group, with a note where the sample is small."""
    medians = group_quantiles(df, value, [0.5], ["median_price"], [group])
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(number(df, value)).alias("n"))
    note = F.when(F.col("n") < SMALL_SAMPLE, SMALL_SAMPLE_NOTE).otherwise("")
    return counts.join(medians, group, "left").select(group, "median_price", "n", note.alias("note"))


def group_median_sorted(df: DataFrame, group: str, value: str) -> DataFrame:
    return group_quantiles(df, value, [0.5], ["median_price"], [group]).orderBy("median_price", group)


def group_mean(df: DataFrame, group: str, value: str, out: str = "mean_value") -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(number(df, value)).alias(out))


def top_bottom_groups(df: DataFrame, group: str, value: str, size: int = 10) -> DataFrame:
    """The groups with the highest and lowest means, as (side, group, mean_value)."""
    means = group_mean(df, group, value)
    top = means.orderBy(F.desc("mean_value"), group).limit(size).withColumn("side", F.lit("top"))
    bottom = means.orderBy(F.asc("mean_value"), group).limit(size).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", group, "mean_value")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n) including NULL, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc_nulls_last(column))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def box_stats(df: DataFrame, category: str, value: str) -> DataFrame:
    """Count, quartiles and whiskers (furthest values within 1.5 IQR) per category."""
    quartiles = group_quantiles(df, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"], [category])
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.withColumn("fence_low", F.col("q1") - WHISKER * spread).withColumn(
        "fence_high", F.col("q3") + WHISKER * spread
    )
    joined = lookup_join(df, fences, [category], "inner")
    v = number(df, value)
    inside = v.between(F.col("fence_low"), F.col("fence_high"))
    return joined.groupBy(category).agg(
        F.count(v).alias("n"),
        F.max("q1").alias("q1"),
        F.max("median").alias("median"),
        F.max("q3").alias("q3"),
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"),
    )


def histogram(
    df: DataFrame, value: str, low: float, high: float, bins: int, groups: Sequence[str] = ()
) -> DataFrame:
    """(groups, bin, bin_low, bin_high, n, density) over fixed bins; the last bin is closed.

    Bins without rows are absent. Density integrates to 1 per group.
    """
    width = (high - low) / bins
    v = number(df, value)
    inside = df.where(v.between(low, high))
    slot = F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int")
    counts = inside.groupBy(*groups, slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = [(F.lit(low) + F.col("bin") * width).alias("bin_low"), (F.lit(low) + (F.col("bin") + 1) * width).alias("bin_high")]
    if groups:
        totals = counts.groupBy(*groups).agg(F.sum("n").alias("_total"))
        counts = counts.join(totals, list(groups))
    else:
        counts = counts.withColumn("_total", counts.agg(F.sum("n")).scalar())
    return counts.select(*groups, "bin", *edges, "n", (F.col("n") / (F.col("_total") * width)).alias("density"))


def equal_width_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Histogram whose range is the data's own."""
    v = number(df, value)
    edges = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    if edges["lo"] is None:
        return histogram(df, value, 0.0, 1.0, bins)
    high = edges["hi"] if edges["hi"] > edges["lo"] else edges["lo"] + 1.0
    return histogram(df, value, edges["lo"], high, bins)


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, batches)


def missing_groups(everything: DataFrame, part: DataFrame, group: str) -> DataFrame:
    """Groups of the whole that a part lacks."""
    return distinct_keys(everything, group).join(distinct_keys(part, group), group, "left_anti")


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the member set."""
    return df.join(sized(members.select(key).distinct()), key, "left_semi")


def align_to_keys(keys: DataFrame, values: DataFrame, key: str, fill: dict[str, Column | float | int]) -> DataFrame:
    """Left join values to a key set and fill the gaps."""
    joined = keys.join(values, key, "left")
    return joined.withColumns({
        name: F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value)) for name, value in fill.items()
    })
