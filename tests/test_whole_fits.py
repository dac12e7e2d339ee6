"""The comparison of models fits its trees on every training row, with none drawn or set aside."""

import random

import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from hearthrate.functions.keyed import split_side
from hearthrate.operators import models
from hearthrate.operators.design import assemble_vector
from hearthrate.plans import flows
from suite import modelling


@pytest.fixture
def rows(spark):
    """More training rows than either draw would take."""
    draw = random.Random(3)
    data = [(str(i), *(draw.gauss(0, 1) for _ in modelling.FEATURES), 4 + draw.random()) for i in range(3_000)]
    names = ", ".join(f"{c} double" for c in modelling.FEATURES)
    sided = spark.createDataFrame(data, f"id string, {names}, label double").withColumn("side", split_side(F.col("id")))
    return assemble_vector(sided, modelling.FEATURES)


@pytest.fixture
def fitted(monkeypatch):
    """Of every tree model the class, the rows it was given, and whether some of them are set aside."""
    seen = []
    for kind, few in ((GBTRegressor, {"maxIter": 2, "maxDepth": 2}), (RandomForestRegressor, {"numTrees": 2, "maxDepth": 2})):
        def fit(self, df, whole=kind.fit, few=few, kind=kind):
            aside = kind is GBTRegressor and self.isSet(self.validationIndicatorCol)
            seen.append((kind, df.count(), aside))
            return whole(self.copy({self.getParam(k): v for k, v in few.items()}), df)

        monkeypatch.setattr(kind, "fit", fit)
    monkeypatch.setattr(models, "FIT_ROWS", 1_000)
    return seen


def test_model_comparison_fits_on_all_training_rows(spark, monkeypatch, rows, fitted):
    monkeypatch.setattr(modelling, "vectors", lambda *_: rows)
    table = modelling.model_comparison(spark, "").collect()
    train = rows.where("side = 'train'").count()
    assert fitted == [(RandomForestRegressor, train, False), (GBTRegressor, train, False)] and train > models.FOREST_ROWS
    assert all(r[f"{side}_{m}"] is not None for r in table for side in ("train", "test") for m in ("mae", "rmse", "r2"))


def test_flow_fits_on_all_training_rows(spark, rows, fitted):
    train, test = modelling.sides(rows)
    flows.compare_models(flows.TrainingSet(None, train, test, rows), cross_validated=False)
    assert fitted == [(RandomForestRegressor, train.count(), False), (GBTRegressor, train.count(), False)]


def test_each_side_is_measured_by_itself(spark, rows):
    train, test = modelling.sides(rows)
    make = lambda _: RandomForestRegressor(seed=1, numTrees=2, maxDepth=3)
    done = models.train_and_evaluate("forest", make, train, test, clip=None)
    for side, data in (("train", train), ("test", test)):
        alone = models.dollar_metrics(done.model.transform(data), clip=None).first()
        assert done.metrics[f"{side}_mae"] == pytest.approx(alone["mae"], rel=1e-12)
    none = models.train_and_evaluate("forest", make, train, test.limit(0), clip=None).metrics
    assert none["test_mae"] is None and none["train_mae"] == pytest.approx(done.metrics["train_mae"], rel=1e-12)
