"""Fingerprints: the algebra, and the comparison with the next document against plain Python."""

import hashlib
import random

import numpy as np

from pyspark.sql import functions as F

from hearthrate.llm.fingerprints import add_fingerprint, alike, compare_with_next, fingerprints, from_text, half_replaced, likeness, merge, remove, to_text


def test_sums_of_paragraphs():
    lines = ["one two three four", "five", "six seven", "", "ünï cödé 🎉", "one two three four"]
    whole = fingerprints(["\n".join(lines)])[0]
    assert (fingerprints(lines).sum(axis=0, dtype=np.uint64) == whole).all()
    shuffled = random.Random(1).sample(lines, len(lines))
    assert (fingerprints(["\n".join(shuffled)])[0] == whole).all()
    assert (fingerprints(["\n".join(lines[1:])])[0] + fingerprints(lines[:1])[0] == whole).all()
    assert (fingerprints(["one two three four"])[0] != whole).any()
    assert not fingerprints(["", "\n\n"]).any()


def test_batching_does_not_matter():
    texts = [" ".join(random.Random(i).choices(["a", "b", "c", "d\n", "e\n"], k=i)) for i in range(60)]
    together = fingerprints(texts)
    assert all((fingerprints([t])[0] == row).all() for t, row in zip(texts, together))


def expected(rows):
    from functools import cmp_to_key
    out, order = {}, sorted(rows, key=lambda r: -r[0])
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        out[i] = (len(t or ""), hashlib.sha256(half_replaced(t or "", n or "").encode()).hexdigest())
    return out


def test_next_document(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    for parts in (1, 7, 40):
        got = compare_with_next(documents, partitions=parts).collect()
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == expected(rows)
        assert len(got) == len(rows)
    texts = dict(rows)
    order = sorted(texts, reverse=True)
    prints = {i: fingerprints([texts[i]]) for i in order}
    by = {r.doc_id: r for r in got}
    for a, b in list(zip(order, order[1:] + order[:1]))[:40]:
        edited = fingerprints([half_replaced(texts[a], texts[b])])
        assert (by[a].fingerprint, by[a].edited_fingerprint) == (to_text(prints[a])[0], to_text(edited)[0])
        assert (by[a].near_edited, by[a].near_next) == (likeness(prints[a], edited)[0], likeness(prints[a], prints[b])[0])
    assert np.mean([r.near_edited > r.near_next for r in got if r.n_chars > 200]) > 0.97


def test_edges(docs_of):
    assert compare_with_next(docs_of([])).collect() == []
    lone = compare_with_next(docs_of([(5, "abcd")])).collect()
    assert [(r.n_chars, r.edited_sha256, r.near_next) for r in lone] == [(4, hashlib.sha256(b"abab").hexdigest(), 1.0)]
    rows = [(1, "x y"), (1, "x y"), (2, None), (None, "last"), (3, ""), (2, "tie")]
    got = compare_with_next(docs_of(rows).selectExpr("*", "'n' AS fingerprint", "1 AS key", "2 AS at")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == [(False, 1, 3), (False, 1, 3), (False, 2, 0), (False, 2, 3), (False, 3, 0), (True, 0, 4)]
    assert add_fingerprint(docs_of([(1, None), (2, "")])).select("fingerprint").distinct().count() == 1


def test_one_line_very_often(docs_of):
    rows = [(4, "a b c\n" * 40_000), (3, "x y z"), (2, "a b c\n" * 65_536), (1, "")]
    got = {r.doc_id: r for r in compare_with_next(docs_of(rows)).collect()}
    assert got[4].near_edited > 0.99 and got[4].near_next < 0.5
    assert got[2].near_edited > 0.99 and got[2].near_next == 0
    # Each of the very many lines leaves its trace, and likeness is that of the columns.
    assert got[2].fingerprint != got[1].fingerprint
    assert got[4].near_edited == likeness(from_text([got[4].fingerprint]), from_text([got[4].edited_fingerprint]))[0]


def runs_of_three(text):
    out = {}
    for line in text.split("\n"):
        words = line.split(" ")
        for run in ([tuple(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [tuple(words)] if line else []):
            out[run] = out.get(run, 0) + 1
    return out


def test_likeness_estimates_the_cosine_of_counted_runs():
    draw = random.Random(12)
    base = [draw.choice(["red", "green", "blue", "old", "new", "tree", "house"]) + str(draw.randint(0, 40)) for _ in range(900)]
    text = lambda words: "\n".join(" ".join(words[i:i + 30]) for i in range(0, len(words), 30))
    for cut in (0, 300, 600, 900):
        other = base[:900 - cut] + [f"x{draw.randint(0, 500)}" for _ in range(cut)]
        a, b = runs_of_three(text(base)), runs_of_three(text(other))
        dot = sum(n * b.get(r, 0) for r, n in a.items())
        want = dot / (sum(n * n for n in a.values()) * sum(n * n for n in b.values())) ** 0.5
        got = likeness(fingerprints([text(base)]), fingerprints([text(other)]))[0]
        assert abs(got - want) < 0.2 and (cut or got == 1)


def test_columns_are_merged_and_parts_removed(docs_of):
    rows = docs_of([(1, "a b c d\ne f"), (2, "g\n\na b c d"), (3, ""), (4, None)])
    prints = add_fingerprint(rows)
    pairs = prints.crossJoin(prints.select(F.col("doc_id").alias("other"), F.col("text").alias("more"), F.col("fingerprint").alias("second")))
    whole = pairs.withColumn("both", merge("fingerprint", "second")).withColumn("left", remove("both", "second")).withColumn("near", alike("both", "left"))
    for r in whole.collect():
        joined = (r.text or "") + "\n" + (r.more or "")
        assert r.both == to_text(fingerprints([joined]))[0] and r.left == r.fingerprint
        assert r.near == likeness(fingerprints([joined]), fingerprints([r.text or ""]))[0]
    none = prints.select(merge(F.lit(None).cast("string"), "fingerprint").alias("same"), "fingerprint").collect()
    assert all(r.same == r.fingerprint for r in none)
