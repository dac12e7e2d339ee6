"""The audit against plain sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from hearthrate.llm import divergence
from hearthrate.llm.divergence import accumulate, audit_sources

SCHEMA = "text string, lang string, source string, doc_id long"


def terms(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, least=10, top=10):
    rows = [(terms(t), g or "", s or "") for t, g, s, *_ in rows]
    held, count, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for words, lang, source in rows:
        held[lang].update(set(words))
        count[lang, source].update(words)
        groups[lang].add(source)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in held[lang].items() if n >= least)

        def shares(c):
            n = sum(c[t] for t in kept)
            return [1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept]

        share = {s: shares(count[lang, s]) for s in sources}
        whole = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(map(f, share[s], share[o]))) for o in sources if o != s]
            more = [(t, f(p, q)) for t, p, q in zip(kept, share[s], whole) if count[lang, s][t] and p > q]
            for part, found, most in (("pair", pairs, None), ("term", more, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:most])]
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, df.collect()))


def test_whole_table(documents):
    assert result(audit_sources(documents)) == brute([(r.text, r.lang, r.source) for r in documents.collect()])


def made(seed, n):
    draw = random.Random(seed)
    pool = ["a", "b", "Zz", "é", "例例", "x'y", "long" * 30] + [f"{c}{d}" for c in "abcdef" for d in "uvwxyz"]
    return [(" ".join(draw.choices(pool[:draw.randint(2, len(pool))], k=draw.randint(0, 60))), draw.choice(["en", "", None, "one"]),
             draw.choice(["s", "t", "", None, "ü"]), i) for i in range(n)]


@pytest.mark.parametrize("rows", [
    [], [(None, None, None, 1)], [("", "en", "a", 1), (None, "en", "b", None)], [("few words", "en", s, 1) for s in "ab"],
    [("same words in all rows", "en", s, 1) for s in "abc" for _ in range(12)], made(1, 400),
    [*made(2, 200), ("word Other " * 200_000, "en", "s", 5), *[(f"w{i} other", "en", "t", 5) for i in range(20)]],
])
def test_edges(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS term", "2 AS item", "3 AS n", "4 AS peer", "5 AS value")
    assert result(audit_sources(docs)) == brute(rows)


def test_small_passes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 7)
    rows = made(3, 300)
    assert result(audit_sources(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_texts_over_several_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PASS_WORDS", 5)
    texts = ["a b a c", "", "d " * 13 + "a b", "b", "a a e e d a b a e a b d"]
    data, offsets = np.frombuffer(" ".join(texts).encode(), dtype=np.uint8), np.cumsum([0] + [len(t) + 1 for t in texts])
    offsets[-1] -= 1
    n, docs = Counter(), Counter()
    for batch in divergence._count(data, offsets, np.array([0, 0, 1, 1, 0]), [("x", "p"), ("x", "q")]):
        for r in batch.to_pylist():
            n[r["source"], r["term"]] += r["n"]
            docs[r["source"], r["term"]] += r["docs"]
    want_n, want_docs = Counter(), Counter()
    for t, s in zip(texts, "ppqqp"):
        want_n.update((s, w) for w in t.split())
        want_docs.update((s, w) for w in set(t.split()))
    assert (n, docs) == (want_n, want_docs)


def test_accumulated_rows():
    draw = np.random.default_rng(4)
    held = draw.random((40, 6)) < 0.4
    term, source = np.nonzero(held)
    p, zero = draw.integers(1, 10**9, len(term)), draw.integers(1, 10**7, 6)
    full = np.where(held, 0, zero)
    full[term, source] = p
    f = lambda a, b: (a - b) ** 2 // (a + b)
    mix = draw.permutation(len(term))
    for i, total in accumulate(term[mix], source[mix], p[mix], zero):
        for j in range(i + 1, 6):
            want = sum(f(full[t, i], full[t, j]) - f(full[t, i], zero[j]) - f(zero[i], full[t, j]) + f(zero[i], zero[j]) for t in range(40) if held[t, i] and held[t, j])
            assert total[j] == want
        assert not total[:i + 1].any()
