"""Near-duplicates against all pairs on small tables."""

import random
import re

import numpy as np
import pytest

from hearthrate.llm.components import components
from hearthrate.llm.near_dedup import near_duplicates, signature
from hearthrate.llm.scratch import Scratch


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_against_all_pairs(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert result(near_duplicates(documents)) == brute(rows)


def test_groups_whose_members_differ(docs_of):
    draw = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(6):
        base = draw.choices(vocabulary, k=120)
        for _ in range(25):
            copy = list(base)
            for at in draw.sample(range(120), draw.randint(0, 4)):
                copy[at] = draw.choice(vocabulary)
            rows.append((len(rows) * 3, " ".join(copy)))
    draw.shuffle(rows)
    got = result(near_duplicates(docs_of(rows)))
    assert got == brute(rows)
    assert 6 <= len({c for _, c, _ in got.values()}) < 120


def test_signature_estimates_similarity():
    draw = np.random.default_rng(2)
    for n in (3, 40, 3000):
        pool = draw.integers(0, 2**64, size=2 * n, dtype=np.uint64)
        a, b = np.unique(pool[:n + n // 2]), np.unique(pool[n // 2:])
        share = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((signature(a) == signature(b)).mean() - share) < 0.2


def test_components_of_any_shape(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 100)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (7, 6)], "a long, b long")
    got = {r.node: r.component for r in components(edges, Scratch(spark, "test")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(100)}


@pytest.mark.parametrize("rows", [
    [], [(None, "a b c d e f")], [(1, None), (2, ""), (3, " \t\n")], [(4, "A b"), (2, "a B"), (9, "a b c"), (9, "a b c"), (None, "a b")],
    [(1, "x " * 30000), (2, "x " * 20000)],
])
def test_edges(docs_of, rows):
    out = near_duplicates(docs_of(rows).selectExpr("*", "1 AS bucket", "2 AS id", "3 AS part"))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = out.collect()
    assert len(got) == len(rows)
    expected = brute([r for r in rows if r[0] is not None])
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == expected
    assert all(r.component_id is None and not r.kept for r in got if r.doc_id is None)
