"""Language model scores against plain counting and enumerated lattices."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from hearthrate.llm import lm
from hearthrate.llm.lattice import expected_counts, log_marginals, refined, vocabulary
from hearthrate.llm.pieces import model_bytes
from hearthrate.llm.words import split


@pytest.fixture(scope="module")
def model():
    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, model):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows if i is not None}
    counts, ends = Counter(), 0
    for i, text in rows:
        if not held.get(i, False):
            counts.update(tokens(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + bool(ends)
    vocab = vocabulary(model)
    every = sorted({w for _, t in rows for w in tokens(t)})
    data = np.frombuffer(" ".join(every).encode(), dtype=np.uint8)
    words = split(data, np.array([0, len(data)]))
    at = np.arange(len(every))
    weights = np.array([[float(counts[w])] for w in every]).reshape(-1, 1)
    logp = refined(vocab, expected_counts(vocab, vocab.prior, words, at, weights))
    chance = dict(zip(every, log_marginals(vocab, logp, words, at)[:, 0] / math.log(10)))
    stop = (ends + 1) / (n + 2)
    out = []
    for i, text in rows:
        own = tokens(text)
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [*(counts[w] for w in own), ends])
        score = sum(chance[w] + math.log10(1 - stop) for w in own) + math.log10(stop)
        out.append((i, held.get(i, False), len(own) + 1, sum(counts[w] > 0 for w in own) + bool(ends), n, base, score))
    return out


def result(df):
    return [tuple(r) for r in df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]


def compare(got, want):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=order), sorted(want, key=order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


@pytest.mark.parametrize("frequent", [200_000, 50])
def test_against_plain_counting(documents, model, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT_WORDS", frequent)
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    compare(result(lm.score_documents(documents, model)), plain(rows, model))


@pytest.mark.parametrize("rows", [
    [(None, "a b"), (1, None), (2, ""), (3, "A a é " + "x" * 500), (3, "A a é"), (3, "A a é")],
    [(i, "only held out words") for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2],
])
def test_edges(docs_of, model, rows):
    df = docs_of(rows).selectExpr("*", "1 AS key", "2 AS row", "3 AS word")
    compare(result(lm.score_documents(df, model)), plain(rows, model))


def test_empty_table(docs_of, model):
    assert lm.score_documents(docs_of([]), model).collect() == []
