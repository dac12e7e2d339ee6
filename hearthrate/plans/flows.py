"""The flows of the engine: raw tables to features, features to models, models to scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, functions as F

from hearthrate.functions.keyed import fold_of, split_side
from hearthrate.functions.pricing import PRICE_CAP, WIDE_CLIP
from hearthrate.operators.clean import TARGET_DERIVED_COLUMNS, cap_price, clean_listings, drop_columns, drop_missing_target
from hearthrate.operators.design import DesignMatrix, assemble_vector, standardise
from hearthrate.operators.features import listing_features, text_features
from hearthrate.operators.impute import NullPolicy
from hearthrate.operators.models import Trained, boosted, comparison_table, forest, linear, ridge, train_and_evaluate
from hearthrate.operators.panel import attach_panel_features, panel_features, price_lookup
from hearthrate.operators.quality import gate_from_measures, gate_measures
from hearthrate.operators.recency import attach_review_features, review_features
from hearthrate.operators.selection import Selection, select_features
from hearthrate.session import cut_lineage


@dataclass
class FeatureTable:
    table: DataFrame
    policy: NullPolicy
    selection: Selection


def feature_table(
    listings: DataFrame,
    neighbourhoods: DataFrame,
    calendar: DataFrame,
    reviews: DataFrame,
    lexicon: DataFrame,
) -> FeatureTable:
    """Cleaned listings, calendar and reviews to the model's feature table.

    The joined table is written once before the fitted steps: medians,
    variances and correlations then read it instead of repeating the joins.
    """
    featured = text_features(listing_features(listings, neighbourhoods))
    panel = panel_features(
        calendar, "listing_id", "date", ["minimum_nights"], F.col("available") == "t", F.col("available") == "f",
        "minimum_nights", price_lookup(listings, "id", "price", "listing_id"),
    )
    featured = attach_panel_features(featured, panel, "id", "listing_id")
    featured = drop_columns(featured, TARGET_DERIVED_COLUMNS)
    history = review_features(reviews, "listing_id", "date", ["id"], "comments", lexicon)
    featured = cut_lineage(attach_review_features(featured, history, "id", "listing_id"))
    policy = NullPolicy.fit(featured)
    complete = policy.transform(featured)
    selection = select_features(complete)
    return FeatureTable(selection.transform(complete), policy, selection)


def clean_and_gate(listings: DataFrame, path: str, **limits) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Clean the listings into ``path``; the written table, the gate's failures and the rows of each step.

    One pass does it all: the gate is decided from measures observed while the cleaned rows are written.
    ``limits`` are those of the strict gate.
    """
    cleaned = clean_listings(listings)
    seen = Observation("gate")
    cleaned.table.observe(seen, *gate_measures(cleaned.table)).write.mode("overwrite").parquet(path)
    written = listings.sparkSession.read.schema(cleaned.table.schema).parquet(path)
    if written.isEmpty():
        # Where Spark knows the rows to be none it drops the observations; there is next to nothing to count then.
        nothing = dict.fromkeys(["rows", *(f"missing_{i}" for i in range(len(cleaned.table.columns)))], 0)
        steps = {"raw": listings.count(), "priced": drop_missing_target(listings).count(), "distinct": 0}
        return written, gate_from_measures(cleaned.table, nothing, **limits), steps
    return written, gate_from_measures(cleaned.table, seen.get, **limits), cleaned.step_counts()


@dataclass
class TrainingSet:
    design: DesignMatrix
    train: DataFrame
    test: DataFrame
    encoded: DataFrame

    def release(self) -> None:
        """Free the cached vectors when the models are fitted."""
        self.encoded.unpersist()


def training_set(features: DataFrame, key: str = "id", cap: float | None = PRICE_CAP, folds: int = 5) -> TrainingSet:
    """Capped, split and encoded: everything fitted comes from the training side."""
    priced = features.where(F.col("price") > 0)
    capped = cap_price(priced, cap=cap) if cap else priced
    sided = capped.withColumns({"side": split_side(F.col(key)), "fold": fold_of(F.col(key), folds, seed=7)})
    design = DesignMatrix.fit(sided.where(F.col("side") == "train").drop("side", "fold"), key)
    encoded = design.assemble(sided, ["side", "fold"]).persist(StorageLevel.MEMORY_AND_DISK)
    return TrainingSet(
        design, encoded.where(F.col("side") == "train"), encoded.where(F.col("side") == "test"), encoded
    )


def compare_models(data: TrainingSet, cross_validated: bool = True, tree_settings: dict | None = None, key: str = "id") -> tuple[list[Trained], DataFrame]:
    """Linear, ridge, forest and boosted models side by side, best test MAE first, each fitted on all training rows."""
    settings = tree_settings or {}
    fold = "fold" if cross_validated else None

    def make_ridge(train: DataFrame):
        row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("s")).first()
        return ridge(row["n"], row["s"])

    makers = {
        "linear": lambda _: linear(),
        "ridge": make_ridge,
        "forest": lambda _: forest(**settings.get("forest", {})),
        "boosted": lambda _: boosted(**settings.get("boosted", {})),
    }
    trained = [
        train_and_evaluate(name, make, data.train, data.test, fold, clip=WIDE_CLIP) for name, make in makers.items()
    ]
    return trained, comparison_table(data.train, trained)


def standardised_vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """Feature vector of standardised columns, the input of the ridge model."""
    return assemble_vector(standardise(df, features), features)
