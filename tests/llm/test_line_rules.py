"""The counts against plain ones, the field against sums over all labellings, the verdicts against labels."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from hearthrate.llm.chain import Chain, _expected, fit_chain
from hearthrate.llm.line_rules import content_text, judge

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def plain(text):
    text = text or ""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    words = split(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeated = len({k for i, w in enumerate(windows) if times[w] > 1 for k in range(i, i + 5)})
    seen, dup = set(), 0
    for line in text.split("\n"):
        if split(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeated, len(words) < 10 or 100 * repeated > 20 * len(words))


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet").selectExpr("doc_id", "quality = 1 AS good")


def test_counts_and_lines_of_all_documents(documents, labels):
    rows = judge(documents, labels).select("text", "quality", content_text().alias("lines")).collect()
    for r in rows:
        q = r.quality
        assert tuple(q[c] for c in BASE) == plain(r.text)
        lines = (r.text or "").split("\n")
        assert len(q.content) == len(lines) and all((c is None) == (not re.search(r"[^\x20\x09-\x0D]", line)) for c, line in zip(q.content, lines))
        assert r.lines == "\n".join(line for c, line in zip(q.content, lines) if c)
        assert q.content_words == plain(r.lines)[0]
        assert q.kept == (not q.base_failed and 2 * q.content_words >= q.n_words)


def test_held_out_labels(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "quality = 1 AS good")
    seen = judge(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    rows = seen.select("good", "quality").collect()
    good = [r.quality.kept for r in rows if r.good and not r.quality.base_failed]
    bad = [r.quality.kept for r in rows if not r.good]
    assert sum(good) >= 0.98 * len(good) > 100
    assert sum(bad) <= 0.2 * len(bad) and len(bad) > 20


@pytest.mark.parametrize("labelled", [True, False])
def test_edges(docs_of, spark, labelled):
    long = "A longer line of many words. " * 3000 + "\n" + "one\n\ntwo *** three\n" * 3000
    rows = [(1, None), (None, ""), (2, "\n"), (3, "a\n\n a \na\n"), (4, long), (4, long), (5, "\r\x0b x\r\nx\r\nß é|<\n"), (6, "w " * 9), (7, "w w w w w w x y z a b c\n" * 2), (8, "no break at end\n")]
    docs = docs_of(rows).selectExpr("*", "7 AS quality", "8 AS content", "9 AS kept", "1 AS good", "2 AS features")
    labels = spark.createDataFrame([(1, True), (4, True), (4, False), (5, False), (None, True), (99, False), (3, None)] if labelled else [], "doc_id long, good boolean")
    out = judge(docs, labels)
    assert out.columns == ["doc_id", "text", "content", "kept", "good", "features", "quality"]
    got = out.collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    for r in got:
        assert tuple(r.quality[c] for c in BASE) == plain(r.text)
        assert (r.content, r.kept, r.good, r.features) == (8, 9, 1, 2)
    assert len({str(r.quality) for r in got if r.doc_id == 4}) == 1
    assert all(r.quality.content == [None] and not r.quality.kept for r in got if not r.text)
    assert judge(docs.where("false"), labels).count() == 0
    assert "text" not in judge(docs, labels, with_text=False).columns


def paths(chain, x):
    out = {}
    for states in itertools.product((0, 1), repeat=len(x)):
        s = chain.begin[states[0]] + sum(chain.moves[a, b] for a, b in zip(states, states[1:]))
        out[states] = s + sum(chain.weights @ f for f, y in zip(x, states) if y)
    return out


def test_chain_against_all_labellings():
    draw = np.random.default_rng(6)
    lengths = np.array([3, 0, 5, 1, 5, 2])
    x = draw.normal(size=(lengths.sum(), 4))
    chain = Chain(draw.normal(size=4), draw.normal(size=(2, 2)), draw.normal(size=2))
    states = chain.decode(x, lengths)
    parts = [slice(e - n, e) for n, e in zip(lengths, np.cumsum(lengths)) if n]
    weight = draw.random(len(parts)) + 0.5
    want_one, want_moves, want_begin = np.zeros(len(x)), np.zeros((2, 2)), np.zeros(2)
    for part, w in zip(parts, weight):
        scores = paths(chain, x[part])
        assert tuple(states[part].astype(int)) == max(scores, key=scores.get)
        total = sum(np.exp(s) for s in scores.values())
        for path, s in scores.items():
            p = np.exp(s) / total
            want_one[part] += p * np.array(path)
            want_begin[path[0]] += w * p
            for a, b in zip(path, path[1:]):
                want_moves[a, b] += w * p
    one, moves, begin = _expected(chain, x, lengths[lengths > 0], weight)
    assert np.allclose(one, want_one) and np.allclose(moves, want_moves) and np.allclose(begin, want_begin)


def test_neighbours_decide_what_a_line_alone_does_not():
    draw = random.Random(1)
    x, y, lengths = [], [], []
    for _ in range(300):
        state = draw.randint(0, 1)
        lengths.append(12)
        for t in range(12):
            state = state if draw.random() < 0.9 else 1 - state
            clear = draw.random() < 0.4
            x.append([1.0, float(clear and state), float(clear and not state)])
            y.append(state)
    x, y, lengths = np.array(x), np.array(y), np.array(lengths)
    chain = fit_chain(x, y, lengths, np.ones(300))
    alone = Chain(chain.weights, np.zeros((2, 2)), np.zeros(2))
    assert (chain.decode(x, lengths) == y).mean() > (alone.decode(x, lengths) == y).mean() + 0.1
    assert len(Chain(np.zeros(2), np.zeros((2, 2)), np.zeros(2)).decode(np.zeros((0, 2)), np.array([], dtype=int))) == 0
