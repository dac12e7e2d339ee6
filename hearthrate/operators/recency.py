"""Features of a dated text history: recent reviews, sentiment trend and velocity."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.functions.nulls import ratio
from hearthrate.functions.wording import COMPLAINT_WORDS, PRAISE_WORDS, mentions_any
from hearthrate.operators.impute import zero_fill
from hearthrate.operators.sentiment import NEGATIVE_BELOW, POSITIVE_ABOVE, score_sentiment

# Reviews scored per listing, and the most recent of them.
SCORED_REVIEWS = 50
RECENT_REVIEWS = 10
REVIEW_COLUMNS = (
    "avg_sentiment", "recent_sentiment", "sentiment_trend", "pct_positive_reviews", "pct_negative_reviews",
    "positive_keyword_count", "negative_keyword_count", "review_velocity",
)


def recent_rows(
    history: DataFrame, key: str, date: str, ties: Sequence[str], rows: int = SCORED_REVIEWS, rank: str = "recency"
) -> DataFrame:
    """The ``rows`` most recent rows per key, numbered from 1.

    The limit is pushed below the shuffle (a group limit), so even a key with
    most of the history sends only ``rows`` rows per input partition.
    """
    latest = Window.partitionBy(key).orderBy(F.desc(date), *[F.desc(t) for t in ties])
    known = history.where(F.col(key).isNotNull())
    return known.withColumn(rank, F.row_number().over(latest)).where(F.col(rank) <= rows)


def review_velocity(
    history: DataFrame, key: str, date: str, window: Callable[[Column], Column] | None = None
) -> DataFrame:
    """(key, total, recent, review_velocity): share of a key's rows in the last 12 months.

    The window ends at the latest date of the whole table and includes its
    start. ``window`` maps that latest date to another start.
    """
    start = window or (lambda latest: F.add_months(latest, -12))
    cutoff = history.agg(start(F.max(date)).alias("cutoff"))
    inside = F.col(date) >= cutoff.scalar()
    return (
        history.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("total"), F.count(F.when(inside, 1)).alias("recent"))
        .withColumn("review_velocity", ratio(F.col("recent"), F.col("total")))
    )


def sentiment_by_key(
    scored: DataFrame, key: str, score: str = "compound", rank: str = "recency", recent: int = RECENT_REVIEWS
) -> DataFrame:
    """Mean score, recent mean, trend, shares of clear praise and complaint per key.

    Reviews that mention praise or complaint words are counted if ``scored``
    carries the flags ``has_praise`` and ``has_complaint``.
    """
    value = F.col(score)
    keywords = [
        F.sum(flag_column).cast("int").alias(name)
        for flag_column, name in (("has_praise", "positive_keyword_count"), ("has_complaint", "negative_keyword_count"))
        if flag_column in scored.columns
    ]
    return (
        scored.groupBy(key)
        .agg(
            F.avg(value).alias("avg_sentiment"),
            F.avg(F.when(F.col(rank) <= recent, value)).alias("recent_sentiment"),
            F.avg((value > POSITIVE_ABOVE).cast("double")).alias("pct_positive_reviews"),
            F.avg((value < NEGATIVE_BELOW).cast("double")).alias("pct_negative_reviews"),
            *keywords,
        )
        .withColumn("sentiment_trend", F.col("recent_sentiment") - F.col("avg_sentiment"))
    )


def review_features(
    history: DataFrame,
    key: str,
    date: str,
    ties: Sequence[str],
    text: str,
    lexicon: DataFrame,
    scored_reviews: int = SCORED_REVIEWS,
    recent: int = RECENT_REVIEWS,
    window: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """All review features per key. Text is scored only after the recency cut."""
    latest = recent_rows(history, key, date, ties, scored_reviews)
    body = F.coalesce(F.col(text), F.lit(""))
    flagged = latest.select(
        key, "recency", F.col(text).alias("_text"),
        mentions_any(body, PRAISE_WORDS).alias("has_praise"),
        mentions_any(body, COMPLAINT_WORDS).alias("has_complaint"),
    )
    scores = score_sentiment(flagged, [key, "recency", "has_praise", "has_complaint"], "_text", lexicon)
    per_key = sentiment_by_key(scores, key, recent=recent)
    velocity = review_velocity(history, key, date, window).select(key, "review_velocity")
    return per_key.join(velocity, key, "left").select(key, *REVIEW_COLUMNS)


def attach_review_features(entities: DataFrame, features: DataFrame, key: str, review_key: str) -> DataFrame:
    """Left join on the entity table; entities without reviews get zeros."""
    joined = entities.join(features.withColumnRenamed(review_key, key), key, "left")
    filled = zero_fill(joined, REVIEW_COLUMNS)
    counts = ("positive_keyword_count", "negative_keyword_count")
    return filled.withColumns({c: F.col(c).cast("int") for c in counts})
