"""Cleaning, profiling, quality gate, imputation, encoding and selection on hand-built frames."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearthrate.operators import clean, design, groups, impute, profile, quality, selection


def test_cleaning_counts_its_steps(spark):
    rows = [(1, "$1,200.00", None), (1, "$1,200.00", None), (2, None, None), (3, "abc", None)]
    result = clean.clean_listings(spark.createDataFrame(rows, "id int, price string, calendar_updated string"))
    found = sorted((r["id"], r["price"]) for r in result.table.collect() if r["price"] is not None)
    assert found == [(1, 1200.0)]
    assert result.step_counts() == {"raw": 4, "priced": 3, "distinct": 2}
    assert result.dropped_columns == ["calendar_updated"]


def test_clips(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert clean.clip_at_quantile(df, "v", 0.9).agg(F.max("v")).first()[0] == pytest.approx(90.0)
    assert clean.keep_below_quantile(df, "v", 0.9).count() == 91
    signed = df.select((F.col("v") - 50).alias("v"))
    assert clean.clip_symmetric(signed, "v", 0.5).agg(F.min("v"), F.max("v")).first()[:] == pytest.approx((-25.0, 25.0))


def findings(report):
    return {(r["check"], r["column"], r["severity"]) for r in report.collect()}


def test_quality_report_on_small_and_odd_data(spark):
    rows = [(float(i), 1.0, None if i else 2.0, -5.0) for i in range(50)]
    report = quality.quality_report(
        spark.createDataFrame(rows, "v double, same double, empty double, price double"), {"v": "double", "gone": "int"}, "nothing"
    )
    found = findings(report)
    assert ("rows", None, "failure") in found
    assert ("schema", "gone", "failure") in found
    assert ("nulls", "empty", "failure") in found
    assert ("variance", "same", "warning") in found
    assert ("range", "price", "warning") in found
    assert ("target", "nothing", "failure") in found
    assert quality.gate_verdict(report).first()["passed"] == 0


def test_quality_extreme_value_and_classes(spark):
    rows = [(1e6 if i == 0 else float(i % 3), "a" if i else None) for i in range(2000)]
    found = findings(quality.quality_report(spark.createDataFrame(rows, "v double, c string"), target="c"))
    assert ("outliers", "v", "warning") in found
    assert ("target", "c", "warning") in found
    single = findings(quality.target_findings(spark.createDataFrame([("x",)] * 5, "c string"), "c"))
    assert single == {("target", "c", "failure")}


def test_first_matching_keyword_decides():
    assert quality.bounds_for("average_price") == (0, 1e9)
    assert quality.bounds_for("average") == (0, 150)
    assert quality.bounds_for("longitude") == (-180, 180)
    assert quality.bounds_for("name") is None


def strict_frame(spark, rows, price="150.0D", extra=""):
    columns = ", ".join(f"1.0D AS {c}" for c in quality.REQUIRED_COLUMNS if c != "price")
    return spark.range(rows).selectExpr(*f"{price} AS price, {columns}{extra}".split(", "))


def test_strict_gate(spark):
    assert strict_frame(spark, 1000).transform(quality.strict_gate).count() == 0
    reasons = lambda df: {r["check"] for r in quality.strict_gate(df).collect()}
    assert reasons(strict_frame(spark, 1100, "'$120'")) == {"target_not_numeric"}
    assert reasons(strict_frame(spark, 1)) == {"too_few_rows"}
    assert reasons(strict_frame(spark, 1100, extra=", CAST(NULL AS DOUBLE) AS mostly_null")) == {"null_rate"}
    assert "missing_column" in reasons(strict_frame(spark, 2).drop("price"))
    assert reasons(strict_frame(spark, 1100, "nullif(id,5)")) == {"target_has_nulls"}


def test_profile_against_pandas(spark):
    rng = np.random.default_rng(0)
    data = pd.DataFrame({"a": rng.normal(size=500), "b": rng.integers(0, 9, 500).astype(float)})
    data.loc[::7, "a"] = np.nan
    table = profile.describe_numeric(spark.createDataFrame(data)).toPandas().set_index("column")
    expected = data.describe().T
    for mine, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"), ("max", "max")):
        assert table[mine].astype(float).to_numpy() == pytest.approx(expected.loc[table.index, theirs].to_numpy())
    coverage = profile.coverage_report(spark.createDataFrame(data), ["a"]).first()
    assert coverage["filled"] == data["a"].notna().sum()
    assert profile.correlation_matrix(spark.createDataFrame(data), ["a", "b"]).where("a <> b").first()["r"] == pytest.approx(data["a"].corr(data["b"]))


def test_wide_tables_are_profiled_in_chunks(spark):
    wide = spark.range(20).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(130)])
    stats = profile.column_stats(wide).toPandas()
    assert len(stats) == 130
    assert stats.set_index("column").loc["c129", "max"] == 19 * 129


def test_group_mean_ignores_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 9.0), ("b", None)], "g string, v double")
    out = {(r["g"], r["v"]): (r["m"], r["o"]) for r in groups.attach_group_mean(
        groups.attach_group_mean(df, "g", "v", "m"), "g", "v", "o", exclude_self=True).collect()}
    assert out == {("a", 1.0): (2.0, 3.0), ("a", 3.0): (2.0, 1.0), (None, 9.0): (None, None), ("b", None): (None, None)}


def test_dimension_key_must_be_unique(spark):
    facts = spark.createDataFrame([(1,)], "k int")
    with pytest.raises(ValueError):
        groups.attach_dimension(facts, spark.createDataFrame([(1, "a"), (1, "b")], "k int, n string"), ["k"])


def test_null_policy(spark):
    rows = [("h", None, None, 1.0, None, None, "b"), ("h", "90%", "t", 3.0, 2.0, 5.0, "a"), ("h", None, None, None, None, None, None),
            (None, None, None, 100.0, None, None, "a"), ("h", None, None, None, None, None, "b"), ("h", None, None, None, None, None, "a")]
    df = spark.createDataFrame(
        rows, "host_name string, host_response_rate string, host_is_superhost string, beds double, reviews_per_month double, "
              "days_since_last_review double, bathrooms_text string")
    policy = impute.NullPolicy.fit(df)
    assert policy.medians == {"beds": 2.0}
    assert policy.modes == {"bathrooms_text": "a"}
    out = impute.NullPolicy.from_state(policy.to_state()).transform(df).toPandas()
    assert len(out) == 5 and not out.isna().any().any()
    assert sorted(out["days_since_last_review"]) == [5.0, 9999.0, 9999.0, 9999.0, 9999.0]
    assert set(out["host_is_superhost"]) == {"t", "f"}


def test_design_matrix_is_fitted_on_training_rows(spark):
    train = spark.createDataFrame(
        [(1, 100.0, "x", "p", 1.0), (2, 200.0, "y", "p", None), (3, 50.0, "x", "q", 3.0), (4, 70.0, None, "r", 9.0)],
        "id int, price double, room_type string, property_type string, beds double")
    fitted = design.DesignMatrix.fit(train, top={"property_type": 2})
    assert fitted.kept == {"property_type": ["p", "q"]}
    assert fitted.encoded == {"room_type": ["x", "y"], "property_type": ["Other", "p", "q"]}
    assert fitted.features == ["beds", "room_type_y", "property_type_p", "property_type_q"]
    again = design.DesignMatrix.from_json(fitted.to_json())
    fresh = spark.createDataFrame([(9, "unseen", "p")], "id int, room_type string, property_type string")
    assert again.transform(fresh).first().asDict() == {
        "id": 9, "beds": 3.0, "room_type_y": 0, "property_type_p": 1, "property_type_q": 0}


def test_too_many_categories_is_an_error(spark):
    with pytest.raises(ValueError):
        design.categories_of(spark.range(20), F.col("id"), limit=10)


def test_contiguous_folds_are_even(spark):
    ids = spark.range(103).select((F.col("id") * 7 + 3).alias("k")).repartition(6)
    folds = design.contiguous_folds(ids, "k", 5).toPandas().sort_values("k")
    assert folds["fold"].is_monotonic_increasing
    assert folds["fold"].value_counts().sort_index().tolist() == [21, 21, 21, 20, 20]


def test_standardise_constant_column(spark):
    out = design.standardise(spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double"), ["a", "b"]).collect()
    assert [tuple(r) for r in out] == [(-1.0, 0.0), (1.0, 0.0)]


def test_selection_matches_pandas(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(300, 4)) * [1, 5, 10, 0.001]
    data = pd.DataFrame(base, columns=list("abcd"))
    data["twin"] = data["b"] * 2 + rng.normal(size=300) * 0.1
    data["latitude"] = 47.0
    data.loc[::9, "c"] = np.nan
    data.insert(0, "id", range(300))
    data["price"] = rng.random(300)
    data["label"] = "x"
    df = spark.createDataFrame(data)
    chosen = selection.select_features(df)
    variances = data[["a", "b", "c", "d", "twin"]].var()
    assert [c for c, why in chosen.dropped.items() if why[0] == "low_variance"] == list(variances.index[variances < 0.01 * variances.median()])
    assert [(c, why[1]) for c, why in chosen.dropped.items() if why[0] == "correlated"] == [("twin", "b")]
    assert chosen.selected == ["latitude", "a", "b", "c"]
    assert chosen.transform(df).columns == ["id", "a", "b", "c", "latitude", "price", "label"]
    assert chosen.report(df).count() == 2


def test_box_whiskers(spark):
    data = pd.DataFrame({"c": "x", "v": [1.0, 2, 3, 4, 5, 100]})
    row = groups.box_stats(spark.createDataFrame(data), "c", "v").first()
    assert (row["whisker_low"], row["whisker_high"], row["outliers"], row["n"]) == (1.0, 5.0, 1, 6)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (10.01,)], "v double")
    rows = groups.histogram(df, "v", 0.0, 10.0, 5).orderBy("bin").collect()
    assert [(r["bin"], r["n"]) for r in rows] == [(0, 2), (4, 2)]
    assert sum(r["density"] * 2.0 for r in rows) == pytest.approx(1.0)
