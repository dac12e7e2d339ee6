"""Features of a (key, date) availability panel.

Rates are one hash aggregate with map-side partials. Streaks need row order, so
every key is cut into calendar chunks: each chunk is ordered on its own, and a
streak that crosses a chunk edge is joined again from the first and last state
of the chunks. No key is special, whatever share of the panel it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.functions.calendar import is_off_season, is_peak, is_weekend_night
from hearthrate.functions.nulls import clamp, flag, number, ratio
from hearthrate.operators.impute import fill_with_medians
from hearthrate.session import cut_lineage

# Names of the output columns.
RATE_COLUMNS = (
    "overall_availability_rate", "peak_availability_rate", "off_availability_rate", "pct_weekend_available",
)
PANEL_NUMERIC = (
    "overall_availability_rate", "peak_availability_rate", "off_availability_rate", "availability_gap",
    "pct_weekend_available", "avg_minimum_nights_cal", "consecutive_blocked_rate",
    "estimated_annual_revenue", "peak_demand_score",
)
PANEL_COLUMNS = (*PANEL_NUMERIC, "has_dynamic_minimum")


def panel_rates(panel: DataFrame, key: str, date: str, available: Column, minimum_nights: str) -> DataFrame:
    """Availability overall and by season, mean minimum stay and whether it changes, per key.

    A season without dates gives NULL. "Changes" is ``min <> max``: a distinct
    count would shuffle every value for the same answer.
    """
    open_flag = flag(available).cast("double")
    nights = F.col(minimum_nights)
    day = F.col(date)
    rates = panel.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("dates"),
        F.avg(open_flag).alias("overall_availability_rate"),
        F.avg(F.when(is_peak(day), open_flag)).alias("peak_availability_rate"),
        F.avg(F.when(is_off_season(day), open_flag)).alias("off_availability_rate"),
        F.avg(F.when(is_weekend_night(day), open_flag)).alias("pct_weekend_available"),
        F.avg(nights).alias("avg_minimum_nights_cal"),
        flag(F.min(nights) != F.max(nights)).alias("has_dynamic_minimum"),
    )
    gap = F.col("off_availability_rate") - F.col("peak_availability_rate")
    rates = rates.withColumn("availability_gap", gap)
    return rates.withColumns({c: clamp(F.col(c), 0.0, 1.0) for c in RATE_COLUMNS})


def blocked_streaks(
    panel: DataFrame,
    key: str,
    date: str,
    ties: Sequence[str],
    blocked: Column,
    consecutive_dates: bool = False,
    chunk: str = "month",
) -> DataFrame:
    """(key, dates, blocked_dates, streaks, consecutive_blocked_rate) per key.

    The rate is mean streak length over dates. Mean streak length is blocked
    rows over streaks, so counting the rows that open a streak is enough.
    ``ties`` must make the order within a key unique. With
    ``consecutive_dates`` a missing day also ends a streak. ``chunk`` is the calendar
    unit whose rows of one key are ordered in one task; a panel of timestamps
    takes a smaller one, such as ``hour``.
    """
    ties = [t for t in ties if t not in (key, date)]
    slim = panel.where(F.col(key).isNotNull()).select(key, date, *ties, flag(blocked).alias("_blocked"))
    rows = slim.withColumn("_chunk", F.date_trunc(chunk, date))

    order = [date, *ties]
    in_chunk = Window.partitionBy(key, "_chunk").orderBy(*order)
    before = F.coalesce(F.lag("_blocked").over(in_chunk), F.lit(0))
    joined_up = before == 1
    if consecutive_dates:
        joined_up = joined_up & (F.datediff(F.col(date), F.lag(date).over(in_chunk)) <= 1)
    opens = ((F.col("_blocked") == 1) & ~F.coalesce(joined_up, F.lit(False))).cast("long")
    place = F.struct(*order)
    chunks = (
        rows.withColumn("_opens", opens)
        .groupBy(key, "_chunk")
        .agg(
            F.count(F.lit(1)).alias("dates"),
            F.sum(F.col("_blocked").cast("long")).alias("blocked_dates"),
            F.sum("_opens").alias("opens"),
            F.min_by("_blocked", place).alias("first_state"),
            F.max_by("_blocked", place).alias("last_state"),
            F.min(date).alias("first_date"),
            F.max(date).alias("last_date"),
        )
    )
    across = Window.partitionBy(key).orderBy("_chunk")
    same = (F.col("first_state") == 1) & (F.lag("last_state").over(across) == 1)
    if consecutive_dates:
        same = same & (F.datediff("first_date", F.lag("last_date").over(across)) <= 1)
    totals = (
        chunks.withColumn("_joins", flag(same))
        .groupBy(key)
        .agg(
            F.sum("dates").alias("dates"),
            F.sum("blocked_dates").alias("blocked_dates"),
            (F.sum("opens") - F.sum("_joins")).alias("streaks"),
        )
    )
    mean_length = ratio(F.col("blocked_dates"), F.col("streaks"))
    rate = clamp(F.coalesce(ratio(mean_length, F.col("dates")), F.lit(0.0)), 0.0, 1.0)
    return totals.withColumn("consecutive_blocked_rate", rate)


def demand_scores(features: DataFrame, price: Column) -> DataFrame:
    """Revenue estimate from occupancy, and peak demand (falling back to the overall rate)."""
    overall, peak = F.col("overall_availability_rate"), F.col("peak_availability_rate")
    return features.withColumn("estimated_annual_revenue", price * (1.0 - overall) * 365.0).withColumn(
        "peak_demand_score", price * (1.0 - F.coalesce(peak, overall))
    )


def panel_features(
    panel: DataFrame,
    key: str,
    date: str,
    ties: Sequence[str],
    available: Column,
    blocked: Column,
    minimum_nights: str,
    prices: DataFrame | None = None,
    chunk: str = "month",
) -> DataFrame:
    """All panel features per key. ``prices`` holds (key, price), one row per key."""
    rates = panel_rates(panel, key, date, available, minimum_nights)
    streaks = blocked_streaks(panel, key, date, ties, blocked, chunk=chunk)
    joined = rates.join(streaks.select(key, "consecutive_blocked_rate"), key)
    if prices is None:
        joined = joined.withColumn("price", F.lit(None).cast("double"))
    else:
        known = prices.where(F.col("price").isNotNull()).select(key, "price")
        joined = joined.join(known, key, "left")
    return demand_scores(joined, F.col("price")).select(key, *PANEL_COLUMNS)


def attach_panel_features(
    entities: DataFrame, features: DataFrame, key: str, panel_key: str, when: str = "any_missing"
) -> DataFrame:
    """Left join on the entity table; entities absent from the panel get medians (flag: 0).

    The medians are those of the joined table. ``when='any_missing'`` fills only
    if at least one entity is absent, and then fills every other gap as well;
    ``when='always'`` fills gaps regardless.
    """
    # One row per entity, written once: the medians then read it instead of the panel.
    joined = cut_lineage(entities.join(features.withColumnRenamed(panel_key, key), key, "left"))
    absent = joined.where(F.col("overall_availability_rate").isNull())
    if when == "any_missing" and absent.isEmpty():
        return joined.withColumn("has_dynamic_minimum", F.col("has_dynamic_minimum").cast("int"))
    filled = fill_with_medians(joined, [c for c in PANEL_NUMERIC if c in joined.columns])
    return filled.withColumn("has_dynamic_minimum", F.coalesce(F.col("has_dynamic_minimum"), F.lit(0)))


def price_lookup(entities: DataFrame, key: str, price: str, as_key: str) -> DataFrame:
    """(key, price) pairs with a price."""
    value = number(entities, price)
    return entities.select(F.col(key).alias(as_key), value.alias("price")).where(F.col("price").isNotNull())
