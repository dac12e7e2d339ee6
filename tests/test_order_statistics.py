import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearthrate.operators import quantiles, residuals, skew, validation
from hearthrate.operators.cumulative import average_ranks, cut_points, running_totals

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def frame(rows=60_000):
    rng = np.random.default_rng(5)
    third = rows // 3
    return pd.DataFrame({
        "g": np.r_[np.zeros(third), rng.integers(1, 40, rows - third)].astype(int),
        "smooth": rng.normal(size=rows),
        "tied": rng.integers(0, 5, rows).astype(float),
        "wild": np.where(rng.random(rows) < 1e-4, 1e12, rng.exponential(size=rows)),
    })


def test_global_quantiles_match_numpy(spark):
    data = frame()
    table = quantiles.quantile_table(spark.createDataFrame(data).repartition(7), ["smooth", "tied", "wild"], PROBS)
    found = {r["column"]: r["q"] for r in table.collect()}
    for name in ("smooth", "tied", "wild"):
        assert found[name] == pytest.approx(np.quantile(data[name], PROBS), rel=1e-12)


@pytest.mark.parametrize("limit", [0, 5000])
def test_group_quantiles_with_a_hot_group(spark, monkeypatch, limit):
    """One group holds a third of the rows; both the broadcast and the shuffled bracket join are exact."""
    monkeypatch.setattr(quantiles, "small_side", lambda df: skew.small_side(df, limit))
    data = frame()
    table = quantiles.quantile_table(spark.createDataFrame(data).repartition(5), ["smooth", "wild"], PROBS, ["g"])
    found = {(r["g"], r["column"]): r["q"] for r in table.collect()}
    for group, part in data.groupby("g"):
        for name in ("smooth", "wild"):
            assert found[group, name] == pytest.approx(np.quantile(part[name], PROBS), rel=1e-12)


def test_quantiles_of_little_data(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None), (None, None)], "a double, b double")
    found = quantiles.column_quantiles(df, ["a", "b"], [0.5, 0.95])
    assert found == {"a": pytest.approx([1.5, 1.95])}


@pytest.mark.parametrize("rows", [9_999, 10_000, 10_001])
def test_around_the_size_that_is_counted_whole(spark, rows):
    data = frame(rows)
    table = quantiles.quantile_table(spark.createDataFrame(data), ["smooth", "tied"], PROBS)
    for r in table.collect():
        assert r["q"] == pytest.approx(np.quantile(data[r["column"]], PROBS), rel=1e-12)


def test_brackets_that_miss_are_widened(spark, monkeypatch):
    """Brackets from a far too coarse sketch with no margin."""
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 4)
    monkeypatch.setattr(quantiles, "MARGIN", 1e-9)
    data = frame(30_000)
    table = quantiles.quantile_table(spark.createDataFrame(data).repartition(4), ["smooth", "wild"], PROBS)
    for r in table.collect():
        assert r["q"] == pytest.approx(np.quantile(data[r["column"]], PROBS), rel=1e-12)


def test_no_column_is_ordered_in_one_task(spark):
    data = spark.createDataFrame(frame(30_000))
    plan = quantiles.quantile_table(data, ["smooth"], [i / 100 for i in range(1, 100)])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if " Window " in line]
    assert len(windows) == 2
    assert all("slot" in line for line in windows) and sum("bin" in line.split("],")[-2] for line in windows) >= 1


def test_many_probabilities(spark):
    data = frame(30_000)
    probs = [(i + 0.5) / 99 for i in range(99)]
    found = quantiles.column_quantiles(spark.createDataFrame(data), ["wild"], probs)["wild"]
    assert found == pytest.approx(np.quantile(data["wild"], probs), rel=1e-12)


@pytest.mark.parametrize("name", ["smooth", "tied", "wild"])
def test_average_ranks_match_pandas(spark, name):
    data = frame(20_000)
    ranked = average_ranks(spark.createDataFrame(data), name).toPandas().set_index(name)["rank"]
    expected = data[name].rank()
    assert (data[name].map(ranked) - expected).abs().max() == 0


def test_running_totals_per_group(spark):
    data = frame(5_000)
    counts = data.groupby(["g", "tied"]).size().rename("n").reset_index()
    df = spark.createDataFrame(counts)
    cuts = df.groupBy("g").agg(cut_points(F.col("tied")).alias("cuts"))
    out = running_totals(df, "tied", ["n"], ["g"], cuts).toPandas().sort_values(["g", "tied"])
    expected = counts.sort_values(["g", "tied"])
    assert (out["n_before"].to_numpy() == (expected.groupby("g")["n"].cumsum() - expected["n"]).to_numpy()).all()


def test_spearman_matches_pandas(spark):
    data = frame(10_000)
    data["y"] = data["tied"] + data["smooth"]
    row = residuals.spearman(spark.createDataFrame(data), "tied", "y").first()
    assert row["r"] == pytest.approx(data["tied"].rank().corr(data["y"].rank()), abs=1e-12)
    assert row["n"] == len(data)


def test_t_tail_known_values():
    # Student t with 8 and 98 degrees of freedom.
    assert residuals.t_tail(0.632, 10) == pytest.approx(0.05, abs=5e-4)
    assert residuals.t_tail(0.1966, 100) == pytest.approx(0.05, abs=5e-4)
    assert residuals.t_tail(0.0, 50) == pytest.approx(1.0)
    assert residuals.t_tail(1.0, 50) == 0.0


def test_ks_matches_definition(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=900), rng.normal(0.3, 1, 400).round(1)
    data = pd.DataFrame({"v": np.r_[a, b], "side": ["train"] * 900 + ["test"] * 400})
    row = validation.ks_two_sample(spark.createDataFrame(data), ["v"], "side").first()
    points = np.unique(data["v"])
    gap = np.abs(np.searchsorted(np.sort(a), points, "right") / 900 - np.searchsorted(np.sort(b), points, "right") / 400)
    assert row["statistic"] == pytest.approx(gap.max(), abs=1e-12)
    assert row["passed"] == 0 and row["p_value"] < 0.001
    same = validation.ks_two_sample(spark.createDataFrame(data.assign(side=np.where(np.arange(1300) % 3, "train", "test"))), ["v"], "side").first()
    assert same["passed"] == 1


def test_qq_line_of_normal_values(spark):
    data = pd.DataFrame({"r": np.random.default_rng(2).normal(3, 2, 20_000)})
    fit = residuals.qq_fit(residuals.qq_table(spark.createDataFrame(data), "r")).first()
    assert fit["slope"] == pytest.approx(2, abs=0.05)
    assert fit["intercept"] == pytest.approx(3, abs=0.05)
    assert fit["r2"] > 0.998


def test_local_trend_follows_a_line(spark):
    x = np.linspace(0, 10, 2_000)
    data = pd.DataFrame({"x": x, "y": 4 - 2 * x})
    points = residuals.local_trend(spark.createDataFrame(data), "x", "y", points=11).toPandas()
    assert points["trend"].to_numpy() == pytest.approx((4 - 2 * points["x0"]).to_numpy(), abs=1e-6)


def test_bins_are_sliced_as_their_values_call_for(spark, monkeypatch):
    """Slices of seven values, ties, a heavy tail and a bin of one value give the totals of a plain running sum."""
    monkeypatch.setattr("hearthrate.operators.cumulative.SLICE_VALUES", 7)
    rows = [(g, float(v * v if v % 50 else 10**12 + v), v % 4 + 1) for g in "ab" for v in range(600)]
    counts = spark.createDataFrame(rows, "g string, v double, n long")
    cuts = counts.groupBy("g").agg(F.array(*[F.lit(float(c)) for c in range(0, 224 * 500, 500)]).alias("cuts"))
    got = running_totals(counts, "v", ["n"], ["g"], cuts).toPandas().sort_values(["g", "v"]).reset_index(drop=True)
    assert len(got) == len(rows)
    for _, part in got.groupby("g"):
        assert (part["n_before"] == part["n"].cumsum() - part["n"]).all()
