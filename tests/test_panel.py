import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from hearthrate.operators import panel, recency

START = dt.date(2024, 1, 1)


def calendar(spark, runs, step=1):
    rows = [
        (key, START + dt.timedelta(days=i * step), state, 1 + i % 2)
        for key, states in runs.items() for i, state in enumerate(states)
    ]
    return spark.createDataFrame(rows, "k int, d date, a string, m int")


RUNS = {1: "fftfff", 2: "ttt", 3: ["f", None, "f"], 4: "f"}


@pytest.mark.parametrize("chunk", ["month", "day", "year"])
@pytest.mark.parametrize("parts", [1, 7])
def test_streaks(spark, chunk, parts):
    """Splitting keys into chunks and moving rows around change nothing."""
    df = calendar(spark, RUNS).repartition(parts)
    out = panel.blocked_streaks(df, "k", "d", [], F.col("a") == "f", chunk=chunk).orderBy("k").collect()
    assert [r["consecutive_blocked_rate"] for r in out] == pytest.approx([2.5 / 6, 0.0, 1 / 3, 1.0])
    assert [r["dates"] for r in out] == [6, 3, 3, 1]
    assert [r["streaks"] for r in out] == [2, 0, 2, 1]


@pytest.mark.parametrize("chunk", ["month", "day"])
def test_streaks_match_run_lengths(spark, chunk):
    import random

    source = random.Random(3)
    runs = {k: "".join(source.choice("tf") for _ in range(source.randint(1, 60))) for k in range(30)}
    out = panel.blocked_streaks(calendar(spark, runs), "k", "d", [], F.col("a") == "f", chunk=chunk).collect()
    for row in out:
        lengths = [len(list(g)) for state, g in itertools.groupby(runs[row["k"]]) if state == "f"]
        expected = sum(lengths) / len(lengths) / len(runs[row["k"]]) if lengths else 0.0
        assert row["consecutive_blocked_rate"] == pytest.approx(expected)
        assert row["blocked_dates"] == sum(lengths)


@pytest.mark.parametrize("chunk", ["month", "day"])
def test_missing_days_can_end_a_streak(spark, chunk):
    df = calendar(spark, {1: "fff"}, step=2)
    count = lambda flag: panel.blocked_streaks(df, "k", "d", [], F.col("a") == "f", flag, chunk).first()["streaks"]
    assert count(False) == 1
    assert count(True) == 3


def test_rates_without_a_season(spark):
    rates = panel.panel_rates(calendar(spark, {1: "tft"}), "k", "d", F.col("a") == "t", "m").first()
    assert rates["overall_availability_rate"] == pytest.approx(2 / 3)
    assert rates["peak_availability_rate"] is None and rates["availability_gap"] is None
    assert rates["off_availability_rate"] == pytest.approx(2 / 3)
    assert rates["has_dynamic_minimum"] == 1
    scores = panel.demand_scores(panel.panel_rates(calendar(spark, {1: "tft"}), "k", "d", F.col("a") == "t", "m"), F.lit(90.0)).first()
    assert scores["peak_demand_score"] == pytest.approx(30.0)
    assert scores["estimated_annual_revenue"] == pytest.approx(90 / 3 * 365)


def test_fill_for_absent_entities(spark):
    features = panel.panel_features(calendar(spark, RUNS), "k", "d", [], F.col("a") == "t", F.col("a") == "f", "m")
    entities = spark.createDataFrame([(1,), (2,), (3,), (4,), (99,)], "id int")
    filled = {r["id"]: r for r in panel.attach_panel_features(entities, features, "id", "k").collect()}
    assert filled[99]["overall_availability_rate"] == pytest.approx((0.0 + 1 / 6) / 2)
    assert filled[99]["has_dynamic_minimum"] == 0
    known = spark.createDataFrame([(1,), (2,)], "id int")
    untouched = panel.attach_panel_features(known, features, "id", "k").collect()
    assert all(r["peak_availability_rate"] is None for r in untouched)


def test_recency_ties_and_limit(spark):
    rows = [(1, START + dt.timedelta(days=i // 2), i) for i in range(12)]
    df = spark.createDataFrame(rows, "k int, d date, t int").repartition(5)
    kept = recency.recent_rows(df, "k", "d", ["t"], 3).orderBy("recency").collect()
    assert [r["t"] for r in kept] == [11, 10, 9]


def test_velocity_window_in_a_leap_year(spark):
    rows = [(1, dt.date(2024, 2, 29)), (1, dt.date(2023, 2, 28)), (1, dt.date(2023, 2, 27)), (None, dt.date(2024, 1, 1))]
    out = recency.review_velocity(spark.createDataFrame(rows, "k int, d date"), "k", "d").collect()
    assert [(r["total"], r["recent"]) for r in out] == [(3, 2)]


def test_review_features(spark):
    lexicon = spark.createDataFrame([("clean", 2.0), ("dirty", -2.0)], "word string, valence double")
    rows = [(1, START, 1, "Very clean!"), (1, START, 2, None), (2, START, 3, "dirty and cold")]
    df = spark.createDataFrame(rows, "listing int, d date, id int, text string")
    features = recency.review_features(df, "listing", "d", ["id"], "text", lexicon)
    entities = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    found = {r["id"]: r for r in recency.attach_review_features(entities, features, "id", "listing").collect()}
    assert found[1]["pct_positive_reviews"] == 0.5 and found[1]["positive_keyword_count"] == 1
    assert found[2]["avg_sentiment"] < 0 and found[2]["negative_keyword_count"] == 1
    assert found[3]["avg_sentiment"] == 0 and found[3]["review_velocity"] == 0
