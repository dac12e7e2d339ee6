"""Batch scoring: log predictions to prices with tier, range and wording."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, functions as F

from hearthrate.functions.nulls import number
from hearthrate.functions.pricing import (
    CAPPED_CLIP, confidence_tier, explanation, price_from_log, range_high, range_low,
)
from hearthrate.operators.design import DesignMatrix
from hearthrate.operators.impute import NEVER


def review_signals(
    df: DataFrame, days: str = "days_since_last_review", reviews: str = "number_of_reviews"
) -> tuple[Column, Column]:
    """Recency and count of reviews; a table without them counts as never reviewed."""
    recency = number(df, days) if days in df.columns else F.lit(float(NEVER))
    count = number(df, reviews) if reviews in df.columns else F.lit(0.0)
    return recency, count


def describe_price(df: DataFrame, price: Column, recency: Column, count: Column, floor_zero: bool = False) -> DataFrame:
    """Add price (two decimals), tier, range and explanation; ranges use the unrounded price."""
    tier = confidence_tier(recency, count)
    return df.withColumns({
        "predicted_price": F.bround(price, 2),
        "confidence_tier": tier,
        "price_range_low": range_low(price, floor_zero),
        "price_range_high": range_high(price),
        "confidence_explanation": explanation(tier, price),
    })


def score_listings(
    df: DataFrame,
    design: DesignMatrix,
    model: Model,
    clip: tuple[float, float] = CAPPED_CLIP,
    floor_zero: bool = False,
) -> DataFrame:
    """Encode with the fitted design, predict and describe. A narrow plan: no shuffle."""
    recency, count = review_signals(df)
    carried = df.withColumns({"_recency": recency, "_count": count})
    predicted = model.transform(design.assemble(carried, ["_recency", "_count"]))
    price = price_from_log(F.col("prediction"), clip)
    described = describe_price(predicted, price, F.col("_recency"), F.col("_count"), floor_zero)
    return described.select(
        design.key, "predicted_price", "confidence_tier", "price_range_low", "price_range_high",
        "confidence_explanation",
    )
