import math

import pytest
from pyspark.sql import functions as F

from hearthrate.functions import geo, keyed, nulls, parsing, pricing, wording


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_currency(spark):
    values = ["$1,234.00", " $95 ", "abc", "nan", "", None, "1d", "-$5", "1e3"]
    assert column(spark, values, "string", parsing.currency) == [1234.0, 95.0, None, None, None, None, None, -5.0, 1000.0]


def test_percent(spark):
    assert column(spark, ["95%", " 7 % ", "N/A", None], "string", parsing.percent) == [95.0, 7.0, None, None]


def test_json_item_count(spark):
    values = ['["a","b"]', "[]", "a, b, c", "", "  ", None, '{"k":1}', '{"k":"x,y","j":2}']
    assert column(spark, values, "string", parsing.json_item_count) == [2, 0, 3, 0, 0, 0, 1, 2]


def test_flags_and_dates(spark):
    assert column(spark, ["t", "f", None, "x"], "string", parsing.yes) == [1, 0, 0, 0]
    days = column(spark, ["2024-01-10", "bad", None], "string", lambda v: parsing.days_between(F.to_date(F.lit("2024-01-31")), parsing.day(v)))
    assert days == [21, None, None]


def test_row_mean_skips_missing(spark):
    df = spark.createDataFrame([(1.0, None, 4.0), (None, None, None)], "a double, b double, c double")
    assert [r[0] for r in df.select(parsing.row_mean([F.col(c) for c in "abc"])).collect()] == [2.5, None]


def test_nan_is_missing(spark):
    assert column(spark, [float("nan"), 1.0, None], "double", nulls.no_nan) == [None, 1.0, None]


def test_clamp_keeps_null(spark):
    assert column(spark, [-1.0, 0.5, 9.0, None], "double", lambda v: nulls.clamp(v, 0, 1)) == [0.0, 0.5, 1.0, None]


def test_guarded_corr_on_constant_and_gaps(spark):
    rows = [(1.0, 5.0, 2.0), (2.0, 5.0, None), (3.0, 5.0, 7.0), (4.0, 5.0, 8.0), (None, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "x double, c double, y double")
    row = df.agg(nulls.guarded_corr(F.col("x"), F.col("c")).alias("c"), nulls.guarded_corr(F.col("x"), F.col("y")).alias("y")).first()
    frame = df.toPandas()
    assert row.c is None
    assert row.y == pytest.approx(frame["x"].corr(frame["y"]), abs=1e-12)


def test_corrected_skew_matches_pandas(spark):
    import pandas as pd

    values = [1.0, 2.0, 2.5, 9.0, 30.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(nulls.corrected_skew(F.col("v"))).first()[0] == pytest.approx(pd.Series(values).skew(), abs=1e-12)
    assert spark.createDataFrame([(1.0,), (2.0,)], "v double").agg(nulls.corrected_skew(F.col("v"))).first()[0] is None


def test_distance(spark):
    df = spark.createDataFrame([(47.6062, -122.3321), (48.6062, -122.3321), (None, 1.0)], "lat double, lon double")
    found = [r[0] for r in df.select(geo.distance_to(F.col("lat"), F.col("lon"))).collect()]
    assert found[0] == pytest.approx(0.0, abs=1e-9)
    assert found[1] == pytest.approx(6371.0 * math.pi / 180, rel=1e-9)
    assert found[2] is None


def test_tiers(spark):
    cases = [(364, 6), (365, 6), (1000, 6), (1001, 6), (10, 0), (10, 5), (None, 10), (9999, 0), (None, None), (10, None)]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, d int, n int")
    tiers = [r[0] for r in df.orderBy("i").select(pricing.confidence_tier(F.col("d"), F.col("n"))).collect()]
    assert tiers == ["HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW", "MEDIUM", "LOW", "LOW", "LOW", "LOW"]


def test_buckets_and_ranges(spark):
    values = [0.0, 99.99, 100.0, 200.0, 499.99, 500.0, 501.0, None, -1.0]
    low, mid, high = pricing.BUCKET_LABELS
    assert column(spark, values, "double", pricing.price_bucket) == [low, low, mid, high, high, None, None, None, None]
    closed = column(spark, values, "double", lambda v: pricing.price_bucket(v, include_right_edge=True))
    assert closed[5] == high and closed[6] is None
    opened = column(spark, values, "double", lambda v: pricing.price_bucket(v, pricing.OPEN_EDGES, pricing.OPEN_LABELS))
    assert opened[5] == opened[6] == "$500+"
    assert column(spark, values, "double", pricing.half_width) == [17.0, 17.0, 25.0, 57.0, 57.0, 57.0, 57.0, None, 17.0]
    assert column(spark, [10.0, 100.125], "double", pricing.range_low) == [-7.0, 75.12]
    assert column(spark, [10.0], "double", lambda v: pricing.range_low(v, True)) == [0.0]


def test_explanation_text(spark):
    df = spark.createDataFrame([("HIGH", 150.0)], "t string, p double")
    text = df.select(pricing.explanation(F.col("t"), F.col("p"))).first()[0]
    assert text == (
        "Based on active listing with recent reviews. "
        "Mid-range listings ($100–200) are well-modelled with a typical error of ±$25 (16.9%)."
    )


def test_price_scale(spark):
    assert column(spark, [0.0, -1.0, 1.0, None], "double", pricing.log_price) == [None, None, 0.0, None]
    back = column(spark, [-5.0, math.log(50), 20.0, None], "double", pricing.price_from_log)
    assert back == pytest.approx([1.0, 50.0, 1000.0, None])


def test_rule_price(spark):
    df = spark.createDataFrame([(2, 1.0, 4, 20, 1, 0), (0, 0.0, 1, 0, 0, 0), (9, 5.0, 12, 40, 1, 1)], "b int, t double, a int, m int, s int, v int")
    prices = [r[0] for r in df.select(pricing.rule_price(*[F.col(c) for c in "btamsv"])).collect()]
    assert prices == [110 + 20 + 16 + 14 + 20, 25.0, 490.0]


def test_text_flags(spark):
    text = "Newly renovated PENTHOUSE with city views, hot tub and wood-burning stove"
    df = spark.createDataFrame([(text,), (None,)], "t string")
    first, second = df.select(*wording.pattern_flags(F.lower("t"), wording.DESCRIPTION_PATTERNS)).collect()
    assert {k for k, v in first.asDict().items() if v} == {"has_view", "has_hot_tub", "is_newly_renovated", "has_fireplace", "is_entire_floor"}
    assert not any(second)
    mentioned = column(spark, ["so CLEAN!", "unclean", None], "string", lambda v: wording.mentions_any(v, wording.PRAISE_WORDS))
    assert mentioned == [1, 0, 0]


def test_split_is_stable_when_rows_are_added(spark):
    few, many = (spark.range(n).select("id", keyed.split_side(F.col("id")).alias("s")).toPandas().set_index("id")["s"] for n in (500, 2000))
    assert (few == many.loc[few.index]).all()
    assert 0.17 < (many == "test").mean() < 0.23


def test_folds_cover_all(spark):
    folds = spark.range(3000).select(keyed.fold_of(F.col("id"), 10).alias("f")).groupBy("f").count().toPandas()
    assert sorted(folds["f"]) == list(range(10))
    assert folds["count"].min() > 200


def test_stems_never_lose_a_match(spark):
    """The plain-text guard in front of the patterns agrees with the patterns alone."""
    import itertools
    import re

    words = ["view", "views", "review", "city centre", "city center", "new renovated", "newly renovated", "high end", "high-end",
             "modern", "modernized", "postmodern", "charming", "charms", "wood burning", "spa", "space", "hot tub", "hotttub"]
    texts = [" ".join(pair) for pair in itertools.permutations(words, 2)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    every = {**wording.DESCRIPTION_PATTERNS, **wording.AMENITY_PATTERNS}
    found = df.select("t", *wording.pattern_flags(F.col("t"), every)).toPandas()
    for name, pattern in every.items():
        assert found[name].tolist() == [int(bool(re.search(pattern, t))) for t in found["t"]], name
