"""Sparse encoding against dictionaries, up to very many categories."""

import pytest
from pyspark.sql import functions as F

from hearthrate.operators.sparse import SparseEncoder


def test_small_columns(spark):
    rows = [(1, "b", 3, "x"), (2, "a", None, "x"), (3, None, 10, None), (4, "c", 3, "x"), (5, "", 2, "x")]
    df = spark.createDataFrame(rows, "id long, s string, n long, one string")
    encoder = SparseEncoder.fit(df, ["s", "n", "one"])
    assert encoder.sizes == {"s": 4, "n": 3, "one": 1}
    seen = spark.createDataFrame([*rows, (6, "unseen", 99, "y")], df.schema).withColumn("features", F.lit(0)).withColumn("column", F.lit("kept"))
    got = {r.id: r for r in encoder.transform(seen, "v").collect()}
    # Sorted as text: '' a b c, and 10 2 3; the first of each has no place.
    assert {i: r.v.toArray().tolist() for i, r in got.items()} == {
        1: [0, 1, 0, 0, 1], 2: [1, 0, 0, 0, 0], 3: [0, 0, 0, 0, 0], 4: [0, 0, 1, 0, 1], 5: [0, 0, 0, 1, 0], 6: [0, 0, 0, 0, 0]}
    assert all(r.features == 0 and r.column == "kept" for r in got.values())


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "only")]])
def test_nothing_to_encode(spark, rows):
    df = spark.createDataFrame(rows, "id long, s string")
    got = SparseEncoder.fit(df, ["s"]).transform(df).collect()
    assert [(r.id, r.features.size) for r in got] == [(i, 0) for i, _ in rows]


def test_a_hundred_thousand_categories(spark):
    df = spark.range(120_000).select("id", F.concat(F.lit("c"), F.format_string("%06d", F.col("id") % 100_000)).alias("c"))
    encoder = SparseEncoder.fit(df, ["c"])
    assert encoder.sizes == {"c": 100_000}
    encoded = encoder.transform(df)
    assert encoded.count() == 120_000
    for r in encoded.where("id IN (0, 1, 99999, 100001)").collect():
        at = r.id % 100_000
        assert r.features.size == 99_999 and list(r.features.indices) == ([at - 1] if at else [])
