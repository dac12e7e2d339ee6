"""Running totals and average ranks along a global order, without a single-partition window.

Rows are cut into value bins at sketched quantiles, and every bin into slices
of equal width, as many as its number of distinct values calls for. Each slice
is ordered on its own; the totals before it are those of the bins before, a
table of a few hundred rows, and of the slices before it in its bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.operators.skew import small_side

# Bins are found in two steps of this many comparisons each.
STEP = 15
BINS = STEP * STEP
OFFSET_ROWS = 50_000
# Distinct values a slice of a bin should hold, so the number of slices grows with the data.
SLICE_VALUES = 100_000


def _bin_of(value: Column, cuts: Column) -> Column:
    """How many of the ascending ``BINS - 1`` cuts lie below the value."""
    def below(part: Column) -> Column:
        return F.size(F.filter(part, lambda cut: cut < value))

    every_step = F.array(*[cuts[i] for i in range(STEP - 1, BINS - 1, STEP)])
    coarse = below(every_step)
    return coarse * STEP + below(F.slice(cuts, coarse * STEP + 1, STEP - 1))


def cut_points(value: Column) -> Column:
    """Aggregate: the ascending cuts of a column's values into ``BINS`` bins."""
    return F.percentile_approx(value, [i / BINS for i in range(1, BINS)], 10_000)


def running_totals(
    counts: DataFrame, value: str, totals: Sequence[str], groups: Sequence[str], cuts: DataFrame
) -> DataFrame:
    """Add ``<total>_before``: the sum over strictly smaller values of the group.

    ``counts`` holds one row per (groups, value); ``cuts`` holds (groups, cuts)
    from ``cut_points``. Any cuts give the right totals; good ones even the load.
    """
    keys = list(groups)
    cuts, small = small_side(cuts)
    binned = counts.join(F.broadcast(cuts) if small else cuts, keys)
    binned = binned.withColumn("_bin", _bin_of(F.col(value), F.col("cuts"))).drop("cuts")

    # Each bin's extent and totals, with those of the bins before it: at most BINS rows per group.
    per_bin = binned.groupBy(*keys, "_bin").agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.ceil(F.count(F.lit(1)) / SLICE_VALUES).alias("_slices"),
        *[F.sum(t).alias(f"_sum_{t}") for t in totals],
    )
    earlier = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_bin.select(
        *keys, "_bin", "_low", "_high", "_slices",
        *[F.coalesce(F.sum(f"_sum_{t}").over(earlier), F.lit(0)).alias(f"_base_{t}") for t in totals],
    )
    few_groups = small and cuts.count() * BINS <= OFFSET_ROWS
    based = binned.join(F.broadcast(bases) if few_groups else bases, [*keys, "_bin"])
    wide = F.col("_high").cast("double") - F.col("_low").cast("double")
    along = (F.col(value).cast("double") - F.col("_low").cast("double")) / F.when(wide > 0, wide)
    sliced = based.withColumn("_slice", F.coalesce(F.least(F.floor(along * F.col("_slices")), F.col("_slices") - 1), F.lit(0)))

    # One shuffle by slice serves the sums, their join and the order inside a slice.
    place = [*keys, "_bin", "_slice"]
    per_slice = sliced.groupBy(*place).agg(*[F.sum(t).alias(f"_part_{t}") for t in totals])
    before = Window.partitionBy(*keys, "_bin").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(*place, *[F.coalesce(F.sum(f"_part_{t}").over(before), F.lit(0)).alias(f"_skip_{t}") for t in totals])
    within = Window.partitionBy(*place).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.join(offsets, place)
    return placed.select(
        *counts.columns,
        *[
            (F.col(f"_base_{t}") + F.col(f"_skip_{t}") + F.coalesce(F.sum(t).over(within), F.lit(0))).alias(f"{t}_before")
            for t in totals
        ],
    )


def average_ranks(df: DataFrame, value: str) -> DataFrame:
    """(value, n, rank): the average rank all rows holding a value share (ties average)."""
    known = df.where(F.col(value).isNotNull()).select(F.lit(1).alias("_all"), value)
    counts = known.groupBy("_all", value).agg(F.count(F.lit(1)).alias("n"))
    cuts = known.groupBy("_all").agg(cut_points(F.col(value)).alias("cuts"))
    ranked = running_totals(counts, value, ["n"], ["_all"], cuts)
    return ranked.select(value, "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("rank"))
