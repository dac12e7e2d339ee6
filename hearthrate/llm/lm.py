"""Corpus language model: word counts, and word probabilities summed over subword lattices.

Words of the whole corpus are counted once, with their training counts. Piece
probabilities start from the vocabulary's own scores and are re-estimated as
expected uses in the training words. Each distinct word is then scored once, by
the forward recursion over all its segmentations, and the scores are joined
back to the documents: very frequent words are looked up from a table of fixed
size, all others by a shuffle on the word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from hearthrate.llm.language import remainder
from hearthrate.llm.lattice import Tally, Vocabulary, expected_counts, log_marginals, refined, vocabulary
from hearthrate.llm.scratch import Scratch
from hearthrate.llm.words import Words, mix, passes, split

# Words, most frequent first, that every task holds with their scores: about 4 MB.
FREQUENT_WORDS = 80_000
TALLY_WORDS = 200_000
_LN10 = np.log(10.0)


@lru_cache(maxsize=2)
def _vocabulary(model: bytes) -> Vocabulary:
    return vocabulary(model)


def count_words(docs: DataFrame) -> DataFrame:
    """(key, word, trained, uses) of the lower-cased words of ``docs`` (text, training); ``key``: the word's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(tally: Tally) -> pa.RecordBatch:
            names = np.fromiter(tally.slots, dtype=np.uint64, count=len(tally.slots)).view(np.int64)
            counts = tally.weights.astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(tally.spelled, pa.binary()), pa.array(counts[:, 1]), pa.array(counts.sum(axis=1))],
                names=["key", "word", "trained", "uses"])

        tally = Tally(2)
        for batch in batches:
            training = batch.column("training").to_numpy(zero_copy_only=False).astype(np.int64)
            for words in passes(batch.column("text"), lower=True):
                tally.add(words, np.repeat(training[words.at:words.at + len(words)], words.counts()))
                if len(tally.spelled) > TALLY_WORDS:
                    yield rows(tally)
                    tally = Tally(2)
        yield rows(tally)

    counted = docs.select("text", "training").mapInArrow(run, "key long, word binary, trained long, uses long")
    return counted.groupBy("key", "word").agg(F.sum("trained").alias("trained"), F.sum("uses").alias("uses"))


def _words_of(batch: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    """The batch's words, in order; each is one word, as it has no space."""
    spelled = batch.column("word").to_pylist()
    data = np.frombuffer(b" ".join(spelled), dtype=np.uint8)
    return split(data, np.array([0, len(data)])), np.arange(len(spelled))


def train_pieces(words: DataFrame, model: bytes) -> np.ndarray:
    """Log probability of each piece, from its expected uses in the training counts of ``words``."""
    shared = words.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = _vocabulary(shared.value)
        counts = np.zeros((vocab.size, 1))
        for batch in batches:
            own, at = _words_of(batch)
            counts += expected_counts(vocab, vocab.prior, own, at, batch.column("trained").to_numpy().astype(np.float64)[:, None])
        piece = np.flatnonzero(counts[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(counts[piece, 0])], names=["piece", "uses"])

    used = words.where("trained > 0").select("word", "trained").mapInArrow(run, "piece long, uses double")
    # One row for each piece of the vocabulary at most.
    rows = used.groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
    vocab = _vocabulary(model)
    counts = np.zeros((vocab.size, 1))
    counts[rows["piece"], 0] = rows["uses"]
    return refined(vocab, counts)


def score_words(words: DataFrame, logp: np.ndarray, model: bytes) -> DataFrame:
    """(key, trained, uses, logprob): the natural log of each word's probability over all segmentations."""
    shared = words.sparkSession.sparkContext.broadcast((model, logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, table = shared.value
        vocab = _vocabulary(content)
        for batch in batches:
            own, at = _words_of(batch)
            scores = log_marginals(vocab, table, own, at)[:, 0]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("key", "trained", "uses")), pa.array(scores)], names=["key", "trained", "uses", "logprob"])

    return words.mapInArrow(run, "key long, trained long, uses long, logprob double")


def score_documents(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    Tokens are the lower-cased words and one end. ``base_score`` is the add-one
    unigram log10 probability. ``score`` is the log10 marginal probability: before each word
    the text goes on, and at its end it stops, with chances from the training
    texts; a word's probability sums over all its segmentations into pieces.

    A null text is empty and only has its end. Rows without key are scored, and belong to training. Keys
    may repeat: rows are counted, and scored, each. Without training rows the counts are
    0 and pieces keep the vocabulary's own scores. Other columns are dropped.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    fold = F.coalesce(remainder(key, folds) == held_out, F.lit(False))
    base = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), (~fold).alias("training"))
    words = scratch.store(count_words(base))
    totals = words.agg(F.sum("trained"), F.count_if(F.col("trained") > 0)).first()
    ends = base.where("training").count()
    n, v = (totals[0] or 0) + ends, (totals[1] or 0) + (1 if ends else 0)
    stop = (ends + 1) / (n + 2)
    scored = scratch.store(score_words(words, train_pieces(words, model), model))
    scratch.drop(words)
    scale = np.log10(n + 1 * (v + 1))
    valued = scored.select(
        "key", "uses", (F.col("trained") > 0).cast("long").alias("known"),
        (F.log10(F.col("trained") + 1) - F.lit(float(scale))).alias("plain"),
        (F.col("logprob") / float(_LN10) + float(np.log10(1 - stop))).alias("score"),
    )
    top = valued.orderBy(F.desc("uses"), "key").limit(FREQUENT_WORDS).toPandas()
    top = top.sort_values("key")
    end = (int(ends > 0), float(np.log10(ends + 1) - scale), float(np.log10(stop)))
    shared = docs.sparkSession.sparkContext.broadcast((top["key"].to_numpy(), top[["known", "plain", "score"]].to_numpy(dtype=np.float64), end))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what its frequent words add, and one for each distinct other word."""
        keys, values, at_end = shared.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            own = pa.StructArray.from_arrays([batch.column("id"), batch.column("training")], names=["id", "training"])
            for words in passes(batch.column("text"), lower=True):
                size = len(words)
                hashes, doc, names = words.hashes.view(np.int64), words.doc(), row + np.arange(size)
                row += size
                place = np.minimum(np.searchsorted(keys, hashes), max(len(keys) - 1, 0))
                common = keys[place] == hashes if len(keys) else np.zeros(len(hashes), dtype=bool)
                sums = [np.bincount(doc[common], weights=values[place[common], k], minlength=size) + at_end[k] for k in range(3)]
                part = own.slice(words.at, size)
                frame = pa.StructArray.from_arrays(
                    [part.field(0), part.field(1), pa.array(words.counts() + 1), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])],
                    names=["id", "training", "n_tokens", "known", "plain", "score"])
                # A document's own row joins nothing; its key only spreads it.
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(mix(names.astype(np.uint64)).view(np.int64)), pa.nulls(size, pa.int32()), frame], names=columns)
                rare = np.flatnonzero(~common)
                order = rare[np.lexsort((hashes[rare], doc[rare]))]
                changes = (np.diff(doc[order]) != 0) | (np.diff(hashes[order]) != 0)
                new = np.flatnonzero(np.append(True, changes)[:len(order)])
                times = np.diff(np.append(new, len(order))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[doc[order[new]]]), pa.array(hashes[order[new]]), pa.array(times), pa.nulls(len(new), frame.type)], names=columns)

    columns = ["row", "key", "times", "own"]
    parts = base.mapInArrow(run, "row long, key long, times int, own struct<id:long,training:boolean,n_tokens:long,known:long,plain:double,score:double>")
    joined = parts.join(valued.drop("uses"), "key", "left")
    mine = F.col("own").isNotNull()
    added = joined.select("row", "own", *[F.when(mine, F.col(f"own.{c}")).otherwise(F.col("times") * F.col(c)).alias(f"{c}_") for c in ("known", "plain", "score")])
    summed = added.groupBy("row").agg(F.max("own").alias("own"), *[F.sum(f"{c}_").alias(c) for c in ("known", "plain", "score")])
    return summed.select(
        F.col("own.id").alias(key), (~F.col("own.training")).alias("held_out"), F.col("own.n_tokens").alias("n_tokens"),
        F.col("known").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), F.col("plain").alias("base_score"), "score",
    )
