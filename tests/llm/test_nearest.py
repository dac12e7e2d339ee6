"""Nearest neighbours against brute force: recall, exact scores, ties and unusable vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthrate.llm import nearest as nn

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    dims = [len(v) for i, v in rows if v is not None]
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v) and len(v) == max(dims, key=dims.count)]
    out = {}
    for i, q in good:
        if i % every == 0:
            scored = {}
            for j, v in good:
                if j != i:
                    s = (v * q).sum() / (np.sqrt((v * v).sum()) * np.sqrt((q * q).sum()))
                    scored[j] = max(s, scored.get(j, -2))
            out[i] = sorted(((-s, j) for j, s in scored.items()))[:k]
    return out


def search(spark, rows, **options):
    got = {}
    for r in nn.nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    return got


def same(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [j for _, j in got[q]] == [j for _, j in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=0, atol=1e-12)


def test_few_vectors_are_searched_exactly(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    same(search(spark, rows), brute(rows))


def test_recall_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(nn, "PART_ROWS", 250)
    monkeypatch.setattr(nn, "BLOCK_ROWS", 100)
    monkeypatch.setattr(nn, "BLOCK_QUERIES", 7)
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(40, 24))
    x = centres[draw.integers(0, 40, 4000)] + 0.4 * draw.normal(size=(4000, 24))
    x[1000:2300] = x[999]  # a third of all rows is one vector
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    got, want = search(spark, rows), brute(rows)
    assert got.keys() == want.keys()
    # Nearness reached counts: equal vectors may replace each other only by smaller ids.
    reached = [np.isclose(a[0], b[0], atol=1e-12) for q in want for a, b in zip(got[q], want[q])]
    assert np.mean(reached) >= 0.9
    assert [j for _, j in got[1000]] == [999, 1001, 1002, 1003, 1004]
    router = nn.fit_router(x, len(x))
    assert len(router.b2) == 16
    visited = (np.cumsum(-np.sort(-router.chances(nn.units(x)), axis=1), axis=1) < nn.MASS).sum(axis=1) + 1
    assert visited.mean() < 8


def test_balanced_parts_keep_neighbours_together():
    draw = np.random.default_rng(3)
    x = nn.units(np.repeat(draw.normal(size=(8, 16)), 64, axis=0) + 0.2 * draw.normal(size=(512, 16)))
    graph = nn.neighbour_graph(x, 8)
    label = nn.balanced_parts(x, graph, 8)
    assert np.bincount(label).tolist() == [64] * 8
    assert (label[graph] == label[:, None]).mean() > 0.75


@pytest.mark.parametrize("rows", [
    [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (50, [1.0, 1.0])],
    [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0]), (2, [-1.0, 0.0])],
    [(0, None), (50, [0.0, 0.0]), (100, [1.0, None]), (150, [float("nan"), 1.0]), (200, [float("inf"), 1.0]), (None, [1.0, 1.0]), (250, [1.0, 1.0]), (3, [1.0, 1.0, 1.0]), (4, [2.0, 1.0])],
    [(0, [1.0, 1.0])], [],
])
def test_edges(spark, rows):
    want = {q: v for q, v in brute(rows).items() if v}
    same(search(spark, rows), want)
