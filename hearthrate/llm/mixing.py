"""Mixing documents to target weights with soft domain membership.

A classifier fitted on a labelled table gives every document a probability for
each domain. Document rates start at one and move by projected gradient steps,
never below zero, until the expected tokens of each domain match the targets
in the least-squares sense. A rate depends on the steps and the document's own
probabilities alone, so each step sends a few numbers to all tasks and brings
a few sums back; no document-sized state is kept between steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from hearthrate.llm.batches import append, with_names
from hearthrate.llm.scratch import Scratch
from hearthrate.llm.words import Words, passes

BITS = 18
# Labelled documents the classifier is fitted on, in equal parts from all domains: those of smallest hash.
LABELLED = 4000
# A word is a feature if it is in so many of them and tells some domain apart.
LEAST_HELD = 8
LEAST_CHI = 15.0
PENALTY = 1e-4
STEPS = 120
MOST_ROUNDS = 40
TOLERANCE = 1e-6


@dataclass
class DomainModel:
    """Weights by hashed word and domain; a constant model when nothing is labelled."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, words: Words) -> np.ndarray:
        doc, bucket = features(words)
        z = np.tile(self.bias, (len(words), 1))
        for k in range(len(self.names)):
            z[:, k] += np.bincount(doc, weights=self.weights[bucket, k], minlength=len(words))
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed word) of the distinct words of each text."""
    pair = np.unique((words.doc().astype(np.int64) << BITS) | (words.hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return pair >> BITS, pair & ((1 << BITS) - 1)


def fit_domains(docs: DataFrame, labels: DataFrame, key: str, text: str, sample: int = LABELLED) -> DomainModel:
    """Softmax regression on labelled documents (``key``, ``domain``).

    Every domain of a labelled document with a text is a domain of the model,
    however rare. Each gives ``sample`` divided by the number of domains (one
    at least) documents of smallest hash to the fit; the shares of all labelled
    documents then replace those of the draw. A posterior has a value for each
    domain, so their names and counts are gathered.
    """
    chosen = labels.where(F.col(key).isNotNull() & F.col("domain").isNotNull()).groupBy(key).agg(F.min("domain").alias("domain"))
    rows = docs.select(key, F.col(text).alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in passes(batch.column("text"), lower=True):
                doc, bucket = features(words)
                cuts = np.searchsorted(doc, np.arange(len(words) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("domain").slice(words.at, len(words)), pa.ListArray.from_arrays(cuts, pa.array(bucket.astype(np.int32)))], names=["domain", "buckets"])

    # The sample is drawn on keys; its few rows are sent to the texts, which do not move.
    scratch = Scratch(docs.sparkSession, "domains")
    held = scratch.store(chosen.join(rows.select(key), key, "left_semi"))
    counts = {r.domain: r.n for r in held.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return DomainModel(["all"], np.zeros((1 << BITS, 1)), np.zeros(1))
    names = sorted(counts)
    place = Window.partitionBy("domain").orderBy(F.xxhash64(key), key)
    drawn = held.withColumn("place", F.row_number().over(place)).where(F.col("place") <= max(sample // len(names), 1)).select(key, "domain")
    found = rows.join(F.broadcast(drawn), key).select("domain", "text").mapInArrow(run, "domain string, buckets array<int>").toArrow()
    code = {n: i for i, n in enumerate(names)}
    y = np.array([code[d] for d in found.column("domain").to_pylist()])
    lists = found.column("buckets").combine_chunks()
    row, bucket = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy())), lists.values.to_numpy()
    telling = _telling(row, bucket, y, len(names))[bucket]
    weights, bias = _softmax(row[telling], bucket[telling], y, len(names))
    every = np.array([counts[n] for n in names]) / sum(counts.values())
    return DomainModel(names, weights, bias + np.log(every) - np.log(np.bincount(y, minlength=len(names)) / len(y)))


def _telling(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Marks the hashed words whose presence depends on some domain, by a chi-square of one degree of freedom."""
    held = np.bincount(bucket, minlength=1 << BITS).astype(float)
    mark, n = np.zeros(1 << BITS, dtype=bool), len(y)
    for j in range(k):
        size = (y == j).sum()
        both = np.bincount(bucket[y[row] == j], minlength=1 << BITS)
        spread = held * (n - held) * size * (n - size)
        chi = np.divide((both * n - held * size) ** 2 * n, spread, out=np.zeros(1 << BITS), where=spread > 0)
        mark |= (chi >= LEAST_CHI) & (held >= LEAST_HELD)
    return mark


def _softmax(row: np.ndarray, bucket: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Adam on the penalised cross entropy over sparse rows."""
    used, place = np.unique(bucket, return_inverse=True)
    w, b = np.zeros((len(used), k)), np.log(np.bincount(y, minlength=k) / len(y))
    goal = np.eye(k)[y]
    first, second = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):
        z = np.stack([np.bincount(row, weights=w[place, j], minlength=len(y)) for j in range(k)], axis=1) + b
        e = np.exp(z - z.max(axis=1, keepdims=True))
        d = (e / e.sum(axis=1, keepdims=True) - goal) / len(y)
        g = np.stack([np.bincount(place, weights=d[row, j], minlength=len(used)) for j in range(k)], axis=1) + PENALTY * w
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w -= 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        b -= d.sum(axis=0)
    weights = np.zeros((1 << BITS, k))
    weights[used] = w
    return weights, b


def add_posteriors(docs: DataFrame, model: DomainModel, text: str) -> DataFrame:
    """Add ``tokens``, the number of words, and ``posteriors``, one for each domain of the model."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in passes(batch.column(text), lower=True):
                p = shared.value.posteriors(words)
                part = batch.slice(words.at, len(words))
                offsets = (np.arange(len(words) + 1) * p.shape[1]).astype(np.int32)
                yield append(part, tokens=pa.array(words.counts().astype(np.int64)), posteriors=pa.ListArray.from_arrays(offsets, pa.array(p.ravel())))

    base = docs.drop("tokens", "posteriors")
    return base.mapInArrow(run, with_names(base, {"tokens": T.LongType(), "posteriors": T.ArrayType(T.DoubleType())}))


@dataclass
class Mix:
    """Domains, natural and target expected tokens, the steps taken and the totals reached."""

    names: list[str]
    natural: np.ndarray
    targets: np.ndarray
    steps: list[np.ndarray] = field(default_factory=list)
    reached: np.ndarray | None = None

    def rate(self) -> Column:
        """A document's rate: one, moved by every step, kept at zero or more."""
        moves = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in self.steps]) if self.steps else F.array().cast("array<array<double>>")
        along = lambda step: F.aggregate(F.zip_with("posteriors", step, lambda p, s: p * s), F.lit(0.0), lambda a, x: a + x)
        return F.aggregate(moves, F.lit(1.0), lambda r, step: F.greatest(F.lit(0.0), r + along(step)))


def target_totals(natural: np.ndarray, names: list[str], weights: dict[str, float]) -> np.ndarray:
    """Totals in the proportion of ``weights``, as large as the natural totals allow without repeating a domain."""
    share = np.array([weights.get(n, 0.0) for n in names])
    if not share.sum():
        return natural.copy()
    share = share / share.sum()
    wanted = share > 0
    return share * (natural[wanted] / share[wanted]).min()


def fit_rates(members: DataFrame, names: list[str], weights: dict[str, float] | None = None, factors: dict[str, float] | None = None) -> Mix:
    """Rates for ``members`` (tokens, posteriors) that match the targets.

    Targets are proportions (``weights``) or multiples of the natural totals
    (``factors``, one where a domain is not named). The gradient of the squared error
    is taken in the metric of the documents with a positive rate, so few
    rounds are needed; each round is one aggregate of K + K*K sums.
    """
    k = len(names)
    mix = Mix(names, np.zeros(k), np.zeros(k))

    def sums() -> tuple[np.ndarray, np.ndarray]:
        rated = members.withColumn("rate", mix.rate())
        p = lambda i: F.get("posteriors", i)
        total = [F.sum(F.col("rate") * F.col("tokens") * p(i)) for i in range(k)]
        gram = [F.sum(F.when(F.col("rate") > 0, F.col("tokens") * p(i) * p(j)).otherwise(0.0)) for i in range(k) for j in range(k)]
        row = np.array([x or 0.0 for x in rated.agg(*total, *gram).first()], dtype=float)
        return row[:k], row[k:].reshape(k, k)

    mix.natural, gram = sums()
    mix.targets = target_totals(mix.natural, names, weights) if weights else mix.natural * np.array([(factors or {}).get(n, 1.0) for n in names])
    mix.reached = mix.natural
    best, scale = None, max(mix.natural.sum(), 1.0)
    for _ in range(MOST_ROUNDS):
        error = mix.reached - mix.targets
        off = float(np.abs(error).max()) / scale
        if best is None or off < best[0]:
            best = (off, len(mix.steps), mix.reached)
        if off < TOLERANCE or len(mix.steps) - best[1] > 5:
            break
        ridge = 1e-9 * max(np.trace(gram), 1.0) * np.eye(k)
        mix.steps.append(-np.linalg.solve(gram + ridge, error))
        mix.reached, gram = sums()
    mix.steps, mix.reached = mix.steps[:best[1]], best[2]
    return mix


def mix_sources(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, factors: dict[str, float] | None = None, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Mix]:
    """Every row of ``docs`` with ``tokens``, ``posteriors`` and ``rate``; and the fitted mix.

    ``labels`` has ``key`` and ``domain``; a key with several domains takes the
    first by name. A null or empty text has no tokens and the posterior of the
    labels' shares. Without labels there is one domain, ``all``. Columns with the
    three names are replaced; rows, repeats and other columns are kept.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    model = fit_domains(docs, labels, key, text)
    members = scratch.store(add_posteriors(docs.drop("rate").select(F.col(text), F.col(key)), model, text).select(key, "tokens", "posteriors"))
    mix = fit_rates(members, model.names, weights, factors)
    return add_posteriors(docs.drop("rate"), model, text).withColumn("rate", mix.rate()), mix


def take_by_rate(rated: DataFrame) -> DataFrame:
    """The rows whose rate rounds to a copy; none is repeated, as repeats were removed before."""
    return rated.where(F.col("rate") >= 0.5)
