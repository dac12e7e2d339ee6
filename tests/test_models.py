import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from hearthrate.functions.keyed import fold_of, split_side
from hearthrate.operators import attribution as A, models
from hearthrate.operators.design import assemble_vector
from hearthrate.plans.flows import standardised_vectors
from hearthrate.sources import runs, tables

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3)) * [1, 4, 2] + [0, 10, -3]
    y = 4 + 0.3 * x[:, 0] - 0.05 * x[:, 1] + 0.1 * np.sin(x[:, 2]) + rng.normal(size=400) * 0.05
    return pd.DataFrame(x, columns=FEATURES).assign(id=range(400), label=y)


@pytest.fixture(scope="module")
def rows(spark, data):
    return assemble_vector(spark.createDataFrame(data), FEATURES).withColumn("fold", fold_of(F.col("id"), 5)).persist()


def test_linear_matches_least_squares(data, rows):
    model = models.linear().fit(rows)
    solution, *_ = np.linalg.lstsq(np.c_[np.ones(400), data[FEATURES]], data["label"], rcond=None)
    assert model.intercept == pytest.approx(solution[0], rel=1e-8)
    assert list(model.coefficients) == pytest.approx(list(solution[1:]), rel=1e-8)


def test_ridge_matches_the_closed_form(spark, data):
    z = (data[FEATURES] - data[FEATURES].mean()) / data[FEATURES].std(ddof=0)
    expected = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (data["label"] - data["label"].mean()))
    vectors = standardised_vectors(spark.createDataFrame(data), FEATURES)
    model = models.ridge(400, data["label"].std(ddof=0), standardised=True).fit(vectors)
    assert list(model.coefficients) == pytest.approx(list(expected), rel=1e-6)


def test_cross_validation_uses_only_other_folds(rows):
    table = models.cross_validate(rows, "fold", 5, lambda _: models.linear()).toPandas()
    assert table["n"].sum() == 400
    assert (table["n"] + table["n_train"] == 400).all()
    summary = models.cross_validation_summary(models.cross_validate(rows, "fold", 5, lambda _: models.linear())).first()
    assert summary["mae_mean"] == pytest.approx(table["mae"].mean())
    assert summary["mae_std"] == pytest.approx(table["mae"].std(ddof=0))
    assert summary["worst_fold"] == table.loc[table["mae"].idxmax(), "fold"]
    assert summary["best_fold"] == table.loc[table["mae"].idxmin(), "fold"]


def test_learning_curve_parts_are_nested(spark, rows):
    small = {r["id"] for r in models.training_prefix(rows, "id", 0.2).collect()}
    large = {r["id"] for r in models.training_prefix(rows, "id", 0.6).collect()}
    assert len(small) == 80 and len(large) == 240 and small < large


def test_search_is_reproducible_and_keeps_the_best(rows):
    assert models.draw_parameters(3) == models.draw_parameters(3)
    points = [{"maxDepth": 1}, {"maxDepth": 3}]
    trials = models.random_search(
        rows, "fold", 2, points, lambda p: RandomForestRegressor(numTrees=3, maxDepth=p["maxDepth"], seed=1)
    ).orderBy("trial").collect()
    assert trials[1]["best_so_far"] == min(t["mae"] for t in trials)
    assert trials[0]["improved"] == 1


def test_comparison_marks_the_best(spark, rows):
    train, test = rows.where("fold > 0"), rows.where("fold = 0")
    trained = [models.train_and_evaluate(n, lambda _, d=d: RandomForestRegressor(numTrees=2, maxDepth=d, seed=1), train, test)
               for n, d in (("shallow", 1), ("deep", 5))]
    table = models.comparison_table(rows, trained).toPandas()
    assert table["test_mae"].is_monotonic_increasing
    assert table["best"].tolist() == [1, 0]


def brute_shapley(leaves, x):
    """Path-dependent Shapley values from their definition."""
    used = sorted({f for leaf in leaves for f in leaf.features})

    def expected(known):
        total = 0.0
        for leaf in leaves:
            share = leaf.value
            for f, low, high, cover in zip(leaf.features, leaf.above, leaf.up_to, leaf.shares):
                share *= (1.0 if low < x[f] <= high else 0.0) if f in known else cover
            total += share
        return total

    phi = np.zeros(len(x))
    for f in used:
        others = [o for o in used if o != f]
        for size in range(len(others) + 1):
            for subset in itertools.combinations(others, size):
                weight = math.factorial(size) * math.factorial(len(used) - size - 1) / math.factorial(len(used))
                phi[f] += weight * (expected({*subset, f}) - expected(set(subset)))
    return phi


@pytest.mark.parametrize("estimator", [
    lambda: GBTRegressor(maxIter=4, maxDepth=4, seed=3, subsamplingRate=0.8),
    lambda: RandomForestRegressor(numTrees=4, maxDepth=5, seed=3),
])
def test_tree_attributions(spark, data, rows, estimator):
    model = estimator().fit(rows)
    out = A.tree_attribution(model.transform(rows), "id", FEATURES, model).toPandas().set_index("id").sort_index()
    predicted = model.transform(rows).select("id", "prediction").toPandas().set_index("id").sort_index()["prediction"]
    total = out["base"] + out["phi"].map(sum)
    assert total.to_numpy() == pytest.approx(predicted.to_numpy(), abs=1e-9)
    leaves = A.ensemble_leaves(model, spark)
    for i in (0, 17, 200):
        assert np.array(out.loc[i, "phi"]) == pytest.approx(brute_shapley(leaves, data.loc[i, FEATURES].to_numpy(dtype=float)), abs=1e-9)


def test_linear_attributions_sum_to_the_prediction(spark, data):
    df = spark.createDataFrame(data)
    weights = [0.5, -1.0, 2.0]
    out = A.linear_attribution(df, "id", FEATURES, weights, 1.0).toPandas().set_index("id").sort_index()
    expected = 1.0 + data[FEATURES].to_numpy() @ np.array(weights)
    assert (out["base"] + out["phi"].map(sum)).to_numpy() == pytest.approx(expected)
    long = A.attribution_long(A.linear_attribution(df, "id", FEATURES, weights, 1.0), "id", FEATURES)
    assert long.count() == 1200
    summary = A.attribution_summary(A.linear_attribution(df, "id", FEATURES, weights, 1.0), FEATURES).toPandas()
    assert summary["share_pct"].sum() == pytest.approx(100)
    assert sorted(summary["rank"]) == [1, 2, 3]


def test_stability_ranks_average_ties(spark):
    rows = [(seed, f, v) for seed in A.STABILITY_SEEDS for f, v in (("x", 3.0), ("y", 2.0), ("z", 2.0))]
    table = A.importance_stability(spark.createDataFrame(rows, "seed int, feature string, mean_abs double")).toPandas().set_index("feature")
    assert table["mean_rank"].to_dict() == {"x": 1.0, "y": 2.0, "z": 2.0}
    assert table["stable"].tolist() == [1, 1, 1]


def test_run_files_and_log(spark, tmp_path):
    for run, mae in (("r1", "30.5"), ("r2", "28.25")):
        for kind, name, text in (("metrics", "test_mae", f"1776716149335 {mae} 0\n"), ("params", "model_name", f"m {run}"), ("tags", "production", "true")):
            if kind == "tags" and run == "r1":
                continue
            target = tmp_path / "log" / run / kind / name
            target.parent.mkdir(parents=True, exist_ok=True)
            target.write_text(text)
    found = runs.scan_run_files(spark, str(tmp_path / "log"))
    summary = runs.run_summary(found, ["test_mae"]).collect()
    assert [(r["run_id"], r["test_mae"], r["model_name"], r["production"]) for r in summary] == [("r2", 28.25, "m r2", 1), ("r1", 30.5, "m r1", 0)]
    path = str(tmp_path / "runs")
    runs.append_runs(runs.run_rows(spark, "a", {"depth": 3}, {"test_mae": 0.1}), path)
    runs.append_runs(found, path)
    assert runs.run_summary(runs.read_runs(spark, path), ["test_mae"]).first()["run_id"] == "a"


def test_polygon_names(spark, tmp_path):
    path = tmp_path / "areas.geojson"
    path.write_text('{"type": "FeatureCollection",\n "features": [{"type": "Feature", "properties": {"neighbourhood": "North"},\n'
                    ' "geometry": {"type": "Polygon", "coordinates": [[[1, 2], [3, 4]]]}}, {"type": "Feature", "properties": {"neighbourhood": "South"}}]}')
    names = tables.read_polygon_names(spark, str(path))
    assert sorted(r[0] for r in names.collect()) == ["North", "South"]
    prices = spark.createDataFrame([("North", 120.0)], "neighbourhood string, median_price double")
    assert {r[0]: r[1] for r in tables.polygon_values(names, prices, "neighbourhood").collect()} == {"North": 120.0, "South": None}


def test_draws_are_bounded_and_keyed(spark):
    df = spark.range(20_000).withColumnRenamed("id", "key")
    drawn = models.draw_rows(df, "key", 2_000)
    keys = {r.key for r in drawn.collect()}
    assert abs(len(keys) - 2_000) < 200 and drawn.rdd.getNumPartitions() == 1
    assert keys == {r.key for r in models.draw_rows(df.repartition(7), "key", 2_000).collect()}
    assert models.draw_rows(df.limit(50), "key", 2_000).count() == 50
    # The draw does not follow the split of the same keys.
    sides = df.select("key", split_side(F.col("key")).alias("side")).where(F.col("key").isin(list(keys))).groupBy("side").count().collect()
    assert 0.12 < {r.side: r["count"] for r in sides}["test"] / len(keys) < 0.28


def test_boosting_ends_when_rows_set_aside_gain_nothing(spark):
    draw = np.random.default_rng(0)
    noise = pd.DataFrame({"id": range(600), "x": draw.normal(size=600), "label": draw.normal(size=600)})
    rows = assemble_vector(spark.createDataFrame(noise), ["x"])
    assert models.fit_on_draw(models.boosted(maxIter=30, maxDepth=2), rows, "id").getNumTrees < 30


@pytest.mark.parametrize("alpha", [0.0, 3.0, 500.0])
def test_ridge_from_folds_of_moments(spark, data, alpha):
    rows = spark.createDataFrame(data.assign(fold=data["id"] % 3, flat=1.0))
    moments = models.fold_moments(rows, [*FEATURES, "flat"], "label", "fold")
    got = models.ridge_from_moments(sum(moments.values()) - moments[1], alpha)
    part = data[data["id"] % 3 != 1]
    x, y = part[FEATURES].to_numpy(dtype=float), part["label"].to_numpy()
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean())) / x.std(axis=0)
    assert got[1:-1] == pytest.approx(w, abs=1e-8) and got[-1] == pytest.approx(0, abs=1e-8)
    assert got[0] + got[-1] == pytest.approx(y.mean() - w @ x.mean(axis=0), abs=1e-7)


def test_ridge_search_scores_each_fold_by_the_others(spark, data):
    data = data.assign(fold=data["id"] % 4)
    log = models.ridge_search(spark.createDataFrame(data), FEATURES, "fold", [0.5, 50.0], clip=None).orderBy("trial").collect()
    for row in log:
        maes = []
        for k in range(4):
            train, test = data[data["fold"] != k], data[data["fold"] == k]
            x = train[FEATURES].to_numpy(dtype=float)
            mean, std = x.mean(axis=0), x.std(axis=0)
            z, y = (x - mean) / std, train["label"].to_numpy()
            w = np.linalg.solve(z.T @ z + row.alpha * np.eye(z.shape[1]), z.T @ (y - y.mean()))
            p = y.mean() + ((test[FEATURES].to_numpy(dtype=float) - mean) / std) @ w
            maes.append(np.abs(np.exp(test["label"]) - np.exp(p)).mean())
        assert row.mae == pytest.approx(np.mean(maes), rel=1e-9)


def test_large_models_are_not_sent(spark, rows, monkeypatch):
    monkeypatch.setattr(A, "MOST_NODES", 3)
    model = GBTRegressor(maxIter=2, maxDepth=2, seed=1).fit(rows)
    with pytest.raises(ValueError, match="nodes"):
        A.tree_attribution(rows, "id", FEATURES, model)
