"""Checks that a split or a set of folds is sound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hearthrate.functions.nulls import number, ratio
from hearthrate.operators.cumulative import cut_points, running_totals

SIGNIFICANCE = 0.05
SERIES_TERMS = 100


def kolmogorov_p(statistic: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample statistic."""
    root = F.sqrt(n1.cast("double") * n2 / (n1 + n2))
    reach = (root + 0.12 + F.lit(0.11) / root) * statistic
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        lambda k: F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * reach * reach),
    )
    tail = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)
    # Below this reach the alternating series has not settled, and the tail is 1 to ten digits.
    return F.when(reach < 0.2, 1.0).otherwise(F.least(F.greatest(tail, F.lit(0.0)), F.lit(1.0)))


def ks_two_sample(
    df: DataFrame, columns: Sequence[str], side: str, first: str = "train", second: str = "test"
) -> DataFrame:
    """(column, n1, n2, statistic, p_value, passed): Kolmogorov-Smirnov distance per column.

    Values are counted first, so the ordered work is over distinct values.
    """
    sided = df.where(F.col(side).isin(first, second)).select(side, *[number(df, c).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns])
    values = sided.select(side, F.explode(cells).alias("cell")).select(side, "cell.*").where(F.col("v").isNotNull())
    counts = values.groupBy("column", "v").agg(
        F.count(F.when(F.col(side) == first, 1)).alias("one"),
        F.count(F.when(F.col(side) == second, 1)).alias("two"),
    )
    wide = sided.agg(*[cut_points(F.col(c)).alias(c) for c in columns])
    cuts = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("cuts")) for c in columns
    ])).alias("cell")).select("cell.*")
    stepped = running_totals(counts, "v", ["one", "two"], ["column"], cuts)
    totals = counts.groupBy("column").agg(F.sum("one").alias("n1"), F.sum("two").alias("n2"))
    joined = stepped.join(totals, "column")
    gap = F.abs(
        ratio(F.col("one_before") + F.col("one"), F.col("n1")) - ratio(F.col("two_before") + F.col("two"), F.col("n2"))
    )
    statistics = joined.groupBy("column", "n1", "n2").agg(F.max(gap).alias("statistic"))
    return statistics.withColumn("p_value", kolmogorov_p(F.col("statistic"), F.col("n1"), F.col("n2"))).withColumn(
        "passed", (F.col("p_value") > SIGNIFICANCE).cast("int")
    )


def all_passed(checks: DataFrame) -> DataFrame:
    return checks.agg(F.min("passed").alias("passed"), F.count(F.lit(1)).alias("checks"))


def representation(
    df: DataFrame, group: str, side: str, first: str = "train", second: str = "test"
) -> DataFrame:
    """(group, first, second, missing): rows of each group on both sides of the split."""
    counts = df.where(F.col(group).isNotNull()).groupBy(group).pivot(side, [first, second]).count()
    filled = counts.na.fill(0, [first, second])
    return filled.withColumn("missing", ((F.col(first) == 0) | (F.col(second) == 0)).cast("int"))
