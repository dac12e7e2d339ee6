"""Cleaning steps for a raw listings table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, functions as F

from hearthrate.functions.nulls import clamp, number
from hearthrate.functions.parsing import currency
from hearthrate.functions.pricing import PRICE_CAP
from hearthrate.operators.quantiles import scalar_quantile

# Columns without predictive signal, and columns derived from the target.
UNINFORMATIVE_COLUMNS = (
    "listing_url", "scrape_id", "source", "picture_url", "host_url", "host_thumbnail_url", "host_picture_url",
    "name", "neighborhood_overview", "host_about", "last_scraped", "calendar_last_scraped", "license",
    "estimated_revenue_l365d", "estimated_occupancy_l365d",
)
TARGET_DERIVED_COLUMNS = ("peak_demand_score", "estimated_annual_revenue")


@dataclass
class CleanResult:
    """The cleaned table and, once it has been computed, the rows each step saw."""

    table: DataFrame
    dropped_columns: list[str]
    seen: list[tuple[str, Observation]] = field(default_factory=list)

    def step_counts(self) -> dict[str, int]:
        """Rows before and after each step; waits for the first action on ``table``."""
        return {name: observation.get["rows"] for name, observation in self.seen}


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_missing_target(df: DataFrame, target: str = "price") -> DataFrame:
    return df.where(F.col(target).isNotNull()) if target in df.columns else df


def parse_price(df: DataFrame, target: str = "price") -> DataFrame:
    return df.withColumn(target, currency(F.col(target).cast("string"))) if target in df.columns else df


def drop_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def clean_listings(df: DataFrame, target: str = "price", empty_columns: Sequence[str] = ("calendar_updated",)) -> CleanResult:
    """Drop the empty column, rows without a price and exact copies; parse the price.

    The row counts of all steps are observed while the table itself is computed.
    """
    raw, priced, distinct = Observation("raw"), Observation("priced"), Observation("distinct")
    rows = F.count(F.lit(1)).alias("rows")
    out = drop_columns(df, empty_columns).observe(raw, rows)
    out = drop_missing_target(out, target).observe(priced, rows)
    out = drop_duplicates(parse_price(out, target)).observe(distinct, rows)
    return CleanResult(
        table=out,
        dropped_columns=[c for c in empty_columns if c in df.columns],
        seen=[("raw", raw), ("priced", priced), ("distinct", distinct)],
    )


def cap_price(df: DataFrame, target: str = "price", cap: float = PRICE_CAP) -> DataFrame:
    """Rows priced at or below the cap; rows without a price drop out."""
    return df.where(number(df, target) <= cap)


def cap_report(df: DataFrame, target: str = "price", cap: float = PRICE_CAP) -> DataFrame:
    """Rows before, rows removed by the cap and their percentage."""
    kept = F.count(F.when(number(df, target) <= cap, 1))
    total = F.count(F.lit(1))
    return df.agg(total.alias("rows"), (total - kept).alias("removed")).withColumn(
        "pct_removed", F.try_divide(F.col("removed") * 100.0, F.col("rows"))
    )


def positive_price(df: DataFrame, target: str = "price") -> DataFrame:
    return df.where(number(df, target) > 0)


def clip_at_quantile(df: DataFrame, column: str, prob: float = 0.99, out: str | None = None) -> DataFrame:
    """Values above the quantile are lowered to it."""
    limit = scalar_quantile(df, column, prob)
    value = number(df, column)
    clipped = F.when(value.isNotNull(), F.least(value, F.lit(limit).cast("double")))
    return df.withColumn(out or column, clipped)


def clip_symmetric(df: DataFrame, column: str, prob: float = 0.99, out: str | None = None) -> DataFrame:
    """Values are clipped to plus or minus the quantile of their magnitude."""
    limit = scalar_quantile(df.select(F.abs(number(df, column)).alias("m")), "m", prob) or 0.0
    return df.withColumn(out or column, clamp(number(df, column), -limit, limit))


def keep_below_quantile(df: DataFrame, column: str, prob: float = 0.99) -> DataFrame:
    """Rows at or below the quantile."""
    return df.where(number(df, column) <= F.lit(scalar_quantile(df, column, prob)).cast("double"))
