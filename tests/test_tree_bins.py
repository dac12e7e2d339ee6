"""Tree ensembles see each combination of their bins once, whatever the number of rows."""

import math
import random

import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor

from hearthrate.operators import attribution, models, tree_bins
from hearthrate.operators.design import assemble_vector
from hearthrate.operators.tree_bins import add_bins, predict_by_bins, thresholds

FEATURES = ["a", "b"]


def real_rows(spark, n, seed=5):
    """Distinct real values, with missing ones, signed zeros and infinities."""
    draw = random.Random(seed)
    odd = [(None, 1.0), (math.nan, None), (0.0, -0.0), (-0.0, 0.0), (math.inf, -math.inf), (None, math.nan)]
    rows = odd + [(draw.gauss(0, 1), draw.gauss(0, 1)) for _ in range(n - len(odd))]
    data = [(str(i), a, b, (a or 0.0) * 0.3 if a is not None and math.isfinite(a) else 1.0) for i, (a, b) in enumerate(rows)]
    return assemble_vector(spark.createDataFrame(data, "id string, a double, b double, label double"), FEATURES)


def sent(monkeypatch, kind):
    """The rows that go through the trees of each transform."""
    counts, whole = [], kind.transform

    def transform(self, df, params=None):
        counts.append(df.count())
        return whole(self, df)

    monkeypatch.setattr(kind, "transform", transform)
    return counts


@pytest.mark.parametrize("make, kind", [
    (lambda: RandomForestRegressor(seed=1, numTrees=5, maxDepth=8, maxBins=6), RandomForestRegressionModel),
    (lambda: GBTRegressor(seed=1, maxIter=3, maxDepth=4, maxBins=6), GBTRegressionModel),
])
def test_predictions_by_bins_are_the_models_own(spark, monkeypatch, make, kind):
    fit = real_rows(spark, 400).where("abs(a) < 10 and abs(b) < 10")
    model = make().fit(fit)
    # Values on the thresholds themselves, beside the odd and the unseen ones.
    edges = thresholds(model, spark)
    exact = spark.createDataFrame([(f"t{i}{j}", a, b, 0.0) for i, a in enumerate(edges[0]) for j, b in enumerate(edges[1])], "id string, a double, b double, label double")
    rows = real_rows(spark, 2_000, seed=6).unionByName(assemble_vector(exact, FEATURES))
    rows = rows.unionByName(rows.limit(10))
    wanted = sorted((r.id, r.prediction) for r in model.transform(rows).collect())
    counts = sent(monkeypatch, kind)
    scored = predict_by_bins(model, rows)
    assert scored.columns == [*rows.columns, "prediction"]
    assert sorted((r.id, r.prediction) for r in scored.collect()) == wanted
    assert len(counts) == 1 and counts[0] <= 6 * 6 < rows.count()


def test_comparison_sends_bins_not_rows_through_the_forest(spark, monkeypatch):
    rows = real_rows(spark, 3_000).where("abs(a) < 10 and abs(b) < 10")
    counts = sent(monkeypatch, RandomForestRegressionModel)
    make = lambda _: RandomForestRegressor(seed=1, numTrees=3, maxDepth=4, maxBins=6)
    done = models.train_and_evaluate("forest", make, rows, rows.limit(1_000), draw=("id", 500))
    assert max(counts) <= 6 * 6
    assert {"train_mae", "test_mae"} <= done.metrics.keys()


def test_trees_that_split_by_categories_see_the_rows(spark):
    rows = spark.createDataFrame([(f"c{i % 3}", float(i % 3 == 1)) for i in range(60)], "c string, label double")
    rows = assemble_vector(StringIndexer(inputCol="c", outputCol="i").fit(rows).transform(rows), ["i"])
    model = RandomForestRegressor(seed=1, numTrees=2, maxDepth=2).fit(rows)
    assert thresholds(model, spark) is None
    assert sorted(r.prediction for r in predict_by_bins(model, rows).collect()) == sorted(r.prediction for r in model.transform(rows).collect())


def test_a_single_leaf_gives_every_row_its_value(spark):
    rows = real_rows(spark, 50).withColumn("label", models.F.lit(2.0))
    model = RandomForestRegressor(seed=1, numTrees=2).fit(rows.where("abs(a) < 10 and abs(b) < 10"))
    assert [r.prediction for r in predict_by_bins(model, rows).collect()] == [2.0] * 50


def test_bins_count_the_thresholds_below(spark):
    edges = [[-1.0, 0.0, 2.5], []]
    rows = spark.createDataFrame([(v,) for v in (-2.0, -1.0, -0.5, -0.0, 0.0, 1e-300, 2.5, 3.0, math.nan, None)], "v double")
    got = [(r.x, r.y) for r in add_bins(rows, [rows.v, rows.v], edges, ["x", "y"]).collect()]
    assert got == [(n, 0) for n in (0, 0, 1, 1, 1, 2, 2, 3, 3, 3)]


def test_attributions_by_bins_are_those_of_each_row(spark, capsys, monkeypatch):
    fit = real_rows(spark, 400).where("abs(a) < 10 and abs(b) < 10")
    model = GBTRegressor(seed=1, maxIter=3, maxDepth=4, maxBins=6).fit(fit)
    rows = real_rows(spark, 500, seed=8)
    rows = rows.unionByName(rows.limit(20)).withColumn("id", models.F.when(models.F.col("id") != "3", models.F.col("id")))
    predicted = sorted((str(r.id), r.prediction) for r in model.transform(rows).collect())

    def checked():
        got = attribution.tree_attribution(rows, "id", FEATURES, model)
        assert got.columns == ["id", "base", "phi"]
        totals = sorted((str(r.id), r.base + sum(r.phi)) for r in got.collect())
        assert [k for k, _ in totals] == [k for k, _ in predicted]
        assert [v for _, v in totals] == pytest.approx([v for _, v in predicted], abs=1e-9)
        got.explain()
        return capsys.readouterr().out

    # A few bins hold many rows each: the rows stay where they are.
    plan = checked()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # More combinations than may be sent to every task: joined by a shuffle, as planned.
    monkeypatch.setattr(tree_bins, "BROADCAST_BINS", 1)
    assert "SortMergeJoin" in checked()


def test_bins_of_attributions_are_compiled(spark, capsys):
    """No loop over an array of thresholds for each row."""
    fit = real_rows(spark, 400).where("abs(a) < 10 and abs(b) < 10")
    model = GBTRegressor(seed=1, maxIter=3, maxDepth=4, maxBins=6).fit(fit)
    attribution.tree_attribution(fit, "id", FEATURES, model).explain()
    assert "lambda" not in capsys.readouterr().out
