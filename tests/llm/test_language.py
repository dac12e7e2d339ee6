"""Lattice sums against enumeration, and language prediction on held-out texts."""

import math
import zlib

import numpy as np
import public_tokenizers
import pytest

from hearthrate.llm import lattice
from hearthrate.llm.language import identify
from hearthrate.llm.lattice import Memory, Tally, expected_counts, log_marginals, vocabulary
from hearthrate.llm.pieces import model_bytes
from hearthrate.llm.words import hash_spans, split


@pytest.fixture(scope="module")
def model():
    return model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def words_of(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return split(data, np.array([0, len(data)]))


def enumerate_paths(vocab, spelled):
    """All segmentations as lists of piece indexes, by recursion over prefixes."""
    if not spelled:
        return [[]]
    out = []
    for k in range(1, len(spelled) + 1):
        head = np.frombuffer(spelled[:k], dtype=np.uint8)
        pieces = [] if k == 1 else vocab.find(hash_spans(head, np.array([0]), np.array([k]))).tolist()
        pieces = [p for p in pieces if p >= 0] if k > 1 else [vocab.size - 256 + spelled[0]]
        out += [[p, *rest] for p in pieces for rest in enumerate_paths(vocab, spelled[k:])]
    return out


def test_sums_over_all_segmentations(model):
    vocab = vocabulary(model)
    logp = np.stack([vocab.prior, np.roll(vocab.prior, 7)], axis=1)
    words = words_of("the ñandú a internat zzqx été")
    got = log_marginals(vocab, logp, words, np.arange(6))
    uses = expected_counts(vocab, vocab.prior, words, np.arange(6), np.eye(6))
    for i in range(6):
        paths = enumerate_paths(vocab, b" " + words.text(i))
        assert len(paths) > 1
        for k in range(2):
            assert got[i, k] == pytest.approx(math.log(sum(math.exp(logp[p, k].sum()) for p in paths)))
        chance = np.array([math.exp(vocab.prior[p].sum()) for p in paths])
        for piece in set(sum(paths, [])):
            assert uses[piece, i] == pytest.approx(sum(c * p.count(piece) for c, p in zip(chance, paths)) / chance.sum())


def test_long_words_and_memory(model):
    vocab = vocabulary(model)
    logp = vocab.prior[:, None]
    words = words_of("x" * 1000 + " the the " + "y" * 3)
    memory = Memory(1, limit=2)
    for _ in range(3):
        rows, back = memory.get(words.hashes, lambda at: log_marginals(vocab, logp, words, at))
        assert np.allclose(rows[back], log_marginals(vocab, logp, words, np.arange(4)))
    tally = Tally(2)
    tally.add(words, np.array([0, 1, 1, 0]))
    tally.add(words, np.array([0, 0, 1, 0]))
    assert {w: row.tolist() for w, row in zip(tally.spelled, tally.weights) if len(w) < 9} == {b"the": [1, 3], b"yyy": [2, 0]}
    assert [tally.words().text(i) for i in range(3)] == tally.spelled


def test_held_out_accuracy(spark, sf_dir, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    got = identify(docs, model).collect()
    assert {r.doc_id for r in got} == truth.keys() and len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in truth[r.doc_id][1] or "")) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    assert len(held) > 100
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.97


@pytest.mark.parametrize("rows", [[], [(None, None, None)], [(1, "12 3!", "en"), (1, "", "fr"), (2, None, "de"), (4, "ab", None)]])
def test_edges(spark, model, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'z' AS lang_pred", "1 AS piece")
    out = identify(docs, model)
    assert sorted(out.columns) == ["doc_id", "held_out", "lang", "lang_pred", "piece", "score", "text"]
    got = out.collect()
    assert len(got) == len(rows)
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.text != "ab")


@pytest.mark.parametrize("text", ["x" * 1000 + "the" * 200, "übergrößenträger" * 70, "例えば日本語の長い文" * 50, "a" * 193, "a" * 192])
def test_long_words_against_plain_recursion(model, text):
    vocab = vocabulary(model)
    draw = np.random.default_rng(3)
    table = np.stack([vocab.prior, vocab.prior + draw.normal(size=vocab.size) * 0.3], axis=1)
    words = words_of("the " + text)
    spelled = b" " + text.encode()
    flat = np.frombuffer(spelled, dtype=np.uint8)
    spans = [(s, e) for e in range(1, len(spelled) + 1) for s in range(max(0, e - vocab.longest), e)]
    found = vocab.find(hash_spans(flat, np.array([s for s, _ in spans]), np.array([e for _, e in spans])))
    arcs = {}
    for (s, e), piece in zip(spans, found.tolist()):
        if e - s == 1:
            piece = vocab.size - 256 + spelled[s]
        if piece >= 0:
            arcs.setdefault(e, []).append((s, piece))
    for k in range(2):
        logp = table[:, k]
        alpha = [0.0]
        for e in range(1, len(spelled) + 1):
            alpha.append(np.logaddexp.reduce([alpha[s] + logp[p] for s, p in arcs[e]]))
        assert log_marginals(vocab, table, words, np.array([1]))[0, k] == pytest.approx(alpha[-1], abs=1e-8)
    beta = [-np.inf] * len(spelled) + [0.0]
    uses = np.zeros(vocab.size)
    for e in range(len(spelled), 0, -1):
        for s, p in arcs[e]:
            beta[s] = np.logaddexp(beta[s], logp[p] + beta[e])
            uses[p] += np.exp(alpha[s] + logp[p] + beta[e] - alpha[-1])
    got = expected_counts(vocab, logp, words, np.array([1]), np.array([[2.0, 0.5]]))
    assert np.allclose(got, uses[:, None] * [2.0, 0.5], atol=1e-8)
    # The pieces used cover the word.
    assert uses @ _piece_bytes(vocab, model) == pytest.approx(len(spelled))


def _piece_bytes(vocab, model):
    """Length in bytes of every piece of the vocabulary, found by the hashes of the model's own pieces."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    out = np.ones(vocab.size)
    for p in proto.ModelProto.FromString(model).pieces:
        raw = p.piece.replace("▁", " ").encode()
        at = vocab.find(hash_spans(np.frombuffer(raw, dtype=np.uint8), np.array([0]), np.array([len(raw)])))[0] if len(raw) > 1 else -1
        if at >= 0:
            out[at] = len(raw)
    return out


def test_plain_probabilities_agree_with_log_space(model, monkeypatch):
    vocab = vocabulary(model)
    rng = np.random.default_rng(3)
    raw = b" ".join(bytes(rng.choice(list(b"aeinorst"), n).tolist()) for n in [1, 2, 5, 9, 9, 20, 50, 60, 120, 190, 250]) + " größe überall 東京".encode()
    words = split(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
    which, weights = np.arange(len(words.hashes)), rng.random((len(words.hashes), 2))
    # The second model gives single bytes so little that even short words leave the range of a double.
    rare = vocab.prior.copy()
    rare[-256:] -= 200.0
    logp = np.column_stack([vocab.prior, rare])
    plain = [log_marginals(vocab, table, words, which) for table in (logp[:, :1], logp)], expected_counts(vocab, vocab.prior, words, which, weights)
    monkeypatch.setattr(lattice, "LEAST_LOG", np.inf)
    logs = [log_marginals(vocab, table, words, which) for table in (logp[:, :1], logp)], expected_counts(vocab, vocab.prior, words, which, weights)
    for a, b in zip([*plain[0], plain[1]], [*logs[0], logs[1]]):
        assert np.isfinite(a).all() and np.allclose(a, b, rtol=1e-11, atol=1e-12)


def test_most_strings_are_told_from_pieces_without_the_tables(model, monkeypatch):
    """All arcs are found, though the tables are asked for few of the strings and words are worked on some at a time."""
    vocab = vocabulary(model)
    rng = np.random.default_rng(4)
    spelled = rng.choice(np.frombuffer(b"aeinorstlu", dtype=np.uint8), (300, 12))
    spelled[:, 0] = 0x20
    spans = [(r, s, e) for r in range(300) for s in range(13) for e in range(s + 2, 13) if e - s <= vocab.longest]
    flat = np.ascontiguousarray(spelled).ravel()
    pieces = vocab.find(hash_spans(flat, np.array([r * 12 + s for r, s, _ in spans]), np.array([r * 12 + e for r, _, e in spans])))
    wanted = {(s, e, r, p) for (r, s, e), p in zip(spans, pieces.tolist()) if p >= 0}
    asked, whole = [], lattice.Vocabulary.find
    monkeypatch.setattr(lattice.Vocabulary, "find", lambda self, h: asked.append(len(h)) or whole(self, h))
    got = {(s, e, r, p) for s, e, rows, ps in lattice._arcs(vocab, spelled) if not isinstance(rows, slice) for r, p in zip(rows.tolist(), ps.tolist())}
    assert got == wanted and wanted
    assert sum(asked) - len(wanted) < 0.1 * len(spans)
    raw = b" ".join(bytes(row[1:].tolist()) for row in spelled)
    words = split(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
    at, weights = np.arange(len(words.hashes)), np.ones((len(words.hashes), 1))
    together = expected_counts(vocab, vocab.prior, words, at, weights)
    monkeypatch.setattr(lattice, "CELLS", 200)
    assert np.allclose(expected_counts(vocab, vocab.prior, words, at, weights), together, rtol=1e-12)
