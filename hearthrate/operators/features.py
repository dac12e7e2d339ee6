"""Listing features from structured fields and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hearthrate.functions.geo import CITY_CENTRE, distance_to
from hearthrate.functions.nulls import flag, number, ratio
from hearthrate.functions.parsing import day, days_between, json_item_count, percent, row_mean, years_between, yes
from hearthrate.functions.wording import AMENITY_PATTERNS, DESCRIPTION_PATTERNS, pattern_flags
from hearthrate.operators.clean import UNINFORMATIVE_COLUMNS
from hearthrate.operators.groups import attach_dimension, attach_group_mean

# The review sub-scores averaged into one.
REVIEW_SCORES = (
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_communication", "review_scores_location", "review_scores_value",
)


def host_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "amenities_count": json_item_count(F.col("amenities")),
        "host_experience_years": years_between(day(F.col("last_scraped")), day(F.col("host_since"))),
        "is_superhost": yes(F.col("host_is_superhost")),
        "host_response_rate_num": percent(F.col("host_response_rate")),
        "host_acceptance_rate_num": percent(F.col("host_acceptance_rate")),
        "is_instant_bookable": yes(F.col("instant_bookable")),
        "has_profile_pic": yes(F.col("host_has_profile_pic")),
        "is_identity_verified": yes(F.col("host_identity_verified")),
    })


def activity_features(df: DataFrame) -> DataFrame:
    scores = [number(df, c) for c in REVIEW_SCORES if c in df.columns]
    return df.withColumns({
        "review_score_avg": row_mean(scores),
        "availability_rate": ratio(F.col("availability_365"), F.lit(365)),
        "reviews_active": flag(F.col("number_of_reviews_l30d") > 0),
        "days_since_last_review": days_between(day(F.col("last_scraped")), day(F.col("last_review"))),
    })


def interaction_features(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "size_quality_score": number(df, "accommodates") * number(df, "review_scores_rating"),
        "host_quality_score": F.col("is_superhost") * F.col("review_score_avg"),
    })


def location_features(
    df: DataFrame, neighbourhoods: DataFrame, centre: tuple[float, float] = CITY_CENTRE
) -> DataFrame:
    """Neighbourhood group, distance to the centre, and mean prices of both areas.

    The area means include the row's own price; ``attach_group_mean`` offers the
    form without it.
    """
    out = attach_dimension(df, neighbourhoods, ["neighbourhood_cleansed"])
    out = out.withColumn("distance_to_downtown", distance_to(F.col("latitude"), F.col("longitude"), centre))
    out = attach_group_mean(out, "neighbourhood_cleansed", "price", "neighbourhood_avg_price")
    return attach_group_mean(out, "neighbourhood_group", "price", "neighbourhood_group_avg_price")


def listing_features(
    df: DataFrame, neighbourhoods: DataFrame, drop: Sequence[str] = UNINFORMATIVE_COLUMNS
) -> DataFrame:
    """All structured features; columns without signal are dropped at the end."""
    return (
        df.transform(host_features)
        .transform(activity_features)
        .transform(interaction_features)
        .transform(location_features, neighbourhoods)
        .drop(*drop)
    )


def text_features(df: DataFrame, description: str = "description", amenities: str = "amenities") -> DataFrame:
    """Keyword flags from description and amenities; the description is then dropped."""
    empty = F.lit("")
    about = F.col(description) if description in df.columns else empty
    items = F.col(amenities) if amenities in df.columns else empty
    # Lower-casing once in its own step keeps it from being repeated per pattern.
    lowered = df.withColumns({"_about": F.lower(F.coalesce(about, empty)), "_items": F.lower(F.coalesce(items, empty))})
    return lowered.select(
        *df.columns,
        *pattern_flags(F.col("_about"), DESCRIPTION_PATTERNS),
        *pattern_flags(F.col("_items"), AMENITY_PATTERNS),
    ).drop(description)
