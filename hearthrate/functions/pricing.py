"""Price scale, buckets, confidence tiers and their wording."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from hearthrate.functions.nulls import clamp

# Price cap, bucket edges and labels, half-widths and bucket texts.
PRICE_CAP = 500.0
BUCKET_EDGES = (0.0, 100.0, 200.0, 500.0)
BUCKET_LABELS = ("$0–100", "$100–200", "$200–500")
OPEN_EDGES = (0.0, 100.0, 200.0, 500.0, math.inf)
OPEN_LABELS = ("$0–100", "$100–200", "$200–500", "$500+")
HALF_WIDTHS = (17.0, 25.0, 57.0)
TIERS = ("HIGH", "MEDIUM", "LOW")
TIER_TEXT = {
    "HIGH": "Based on active listing with recent reviews.",
    "MEDIUM": "Moderate confidence — review history is limited or dated.",
    "LOW": "Lower confidence — this listing has minimal review history.",
}
BUCKET_TEXT = {
    "$0–100": "Budget listings ($0–100) are the most predictable with a typical error of ±$17 (23.8%).",
    "$100–200": "Mid-range listings ($100–200) are well-modelled with a typical error of ±$25 (16.9%).",
    "$200–500": (
        "Premium listings ($200–500) have wider ranges due to factors like views and interior quality; "
        "typical error ±$57 (19.5%)."
    ),
}

CAPPED_CLIP = (math.log(1), math.log(PRICE_CAP * 2))
WIDE_CLIP = (math.log(1), math.log(200_000))


def log_price(price: Column) -> Column:
    """Natural log; NULL for prices that are not positive."""
    return F.when(price > 0, F.ln(price))


def price_from_log(value: Column, clip: tuple[float, float] | None = CAPPED_CLIP) -> Column:
    return F.exp(value if clip is None else clamp(value, *clip))


def price_bucket(
    price: Column,
    edges: Sequence[float] = BUCKET_EDGES,
    labels: Sequence[str] = BUCKET_LABELS,
    include_right_edge: bool = False,
) -> Column:
    """Left-closed bins; outside all bins is NULL. The last right edge is open unless asked for."""
    chain = F.when(price < edges[0], F.lit(None).cast("string"))
    for label, high in zip(labels, edges[1:]):
        last = high == edges[-1]
        inside = F.lit(True) if math.isinf(high) else (price <= high if last and include_right_edge else price < high)
        chain = chain.when(price.isNotNull() & inside, F.lit(label))
    return chain


def bucket_rank(label: Column, labels: Sequence[str] = OPEN_LABELS) -> Column:
    """Ordinal of a bucket label, for sorting."""
    chain = F.when(F.lit(False), F.lit(0))
    for position, text in enumerate(labels):
        chain = chain.when(label == text, position)
    return chain


def scoring_bucket(price: Column) -> Column:
    """Bucket used for scoring: prices outside the range take the nearest bucket."""
    first, second, third = BUCKET_LABELS
    return F.when(price < BUCKET_EDGES[1], first).when(price < BUCKET_EDGES[2], second).when(price.isNotNull(), third)


def half_width(price: Column) -> Column:
    first, second, third = HALF_WIDTHS
    return F.when(price < BUCKET_EDGES[1], first).when(price < BUCKET_EDGES[2], second).when(price.isNotNull(), third)


def range_low(price: Column, floor_zero: bool = False) -> Column:
    low = F.bround(price - half_width(price), 2)
    return F.when(low.isNotNull(), F.greatest(low, F.lit(0.0))) if floor_zero else low


def range_high(price: Column) -> Column:
    return F.bround(price + half_width(price), 2)


def confidence_tier(days_since_review: Column, review_count: Column) -> Column:
    """LOW beats HIGH beats MEDIUM; an unknown input never proves a tier, so it ends as LOW."""
    low = (days_since_review > 1000) | (review_count == 0)
    high = (days_since_review < 365) & (review_count > 5)
    medium = days_since_review.between(365, 1000) | review_count.between(1, 5)
    return F.when(low, "LOW").when(high, "HIGH").when(medium, "MEDIUM").otherwise("LOW")


def explanation(tier: Column, price: Column) -> Column:
    def lookup(key: Column, texts: dict[str, str]) -> Column:
        chain = F.when(F.lit(False), F.lit(""))
        for name, text in texts.items():
            chain = chain.when(key == name, text)
        return chain

    return F.concat(lookup(tier, TIER_TEXT), F.lit(" "), lookup(scoring_bucket(price), BUCKET_TEXT))


def rule_price(
    bedrooms: Column,
    bathrooms: Column,
    accommodates: Column,
    amenities: Column,
    superhost: Column,
    view: Column,
) -> Column:
    """Rule-of-thumb price used when no model is at hand."""
    # Dollars per unit of each attribute and the price floor and ceiling.
    raw = (
        bedrooms * F.lit(55.0)
        + bathrooms * F.lit(20.0)
        + F.greatest(F.lit(0.0), accommodates.cast("double") - 2) * F.lit(8.0)
        + amenities * F.lit(0.7)
        + F.when(superhost == 1, 20.0).otherwise(0.0)
        + F.when(view == 1, 15.0).otherwise(0.0)
    )
    return clamp(raw, 25.0, 490.0)
