"""Homomorphic multiset fingerprints of documents.

A paragraph (a non-empty line) is hashed to a wide vector of 64-bit lanes; a
document's fingerprint is the sum of its paragraphs' vectors modulo 2^64. It
does not depend on their order, and paragraphs can be added or taken away
without the rest of the text: ``merge`` and ``remove`` work on fingerprints alone.
The first lanes are uniform in the paragraph's hash and serve equality; the others
are a signed count sketch of its runs of three words, so the cosine of two sketches
estimates how much text is shared. Likeness is that of the fingerprints themselves.
"""

from __future__ import annotations

import binascii
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.functions import pandas_udf

from hearthrate.llm.batches import SLICE_BYTES
from hearthrate.llm.words import hash_spans, mix, split

IDENTITY_LANES = 16
SKETCH_LANES = 256
RUN = 3
# Largest number of ranges of ids that the bounds are asked for; beyond it ranges grow with the table.
MOST_RANGES = 20_000
_LEAST = -(1 << 63)


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of IDENTITY_LANES + SKETCH_LANES unsigned 64-bit lanes for each text."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    out = np.zeros((len(texts), IDENTITY_LANES + SKETCH_LANES), dtype=np.uint64)
    if not len(data):
        return out
    # Paragraphs: stretches between line ends, cut at document ends.
    line = data == 0x0A
    edges = np.unique(np.concatenate([offsets, np.flatnonzero(line), np.flatnonzero(line) + 1]))
    starts, ends = edges[:-1], edges[1:]
    real = ~line[starts]
    starts, ends = starts[real], ends[real]
    doc = np.searchsorted(offsets, starts, "right") - 1
    lanes = np.arange(1, IDENTITY_LANES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    vectors = mix(hash_spans(data, starts, ends)[:, None] + lanes)
    if len(doc):
        begins = np.flatnonzero(np.diff(doc, prepend=-1))
        out[doc[begins], :IDENTITY_LANES] = np.add.reduceat(vectors, begins, axis=0, dtype=np.uint64)
    # Runs of three words inside a paragraph; a shorter paragraph is one run.
    words = split(data, np.append(starts, len(data)) if len(starts) else np.array([0, len(data)]))
    if len(starts) and len(words.hashes):
        home, left = words.doc(), words.first[1:][words.doc()] - np.arange(len(words.hashes))
        size = words.counts()[home]
        h = words.hashes.copy()
        for j in range(1, RUN):
            more = np.zeros(len(h), dtype=np.uint64)
            more[:-j or None] = words.hashes[j:]
            h = np.where(left > j, mix(h + more * np.uint64(2 * j + 1)), h)
        h = h[(left >= RUN) | ((size < RUN) & (left == size))]
        owner = doc[home[(left >= RUN) | ((size < RUN) & (left == size))]]
        lane = (h & np.uint64(SKETCH_LANES - 1)).astype(np.int64)
        sign = ((h >> np.uint64(32)) & np.uint64(1)).astype(np.float64) * 2 - 1
        sums = np.bincount(owner * SKETCH_LANES + lane, weights=sign, minlength=len(texts) * SKETCH_LANES)
        out[:, IDENTITY_LANES:] = sums.astype(np.int64).view(np.uint64).reshape(len(texts), SKETCH_LANES)
    return out


def likeness(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Cosine of the sketches, at least 0; 1 for equal fingerprints, 0 if only one is of an empty text."""
    a, b = (x[:, IDENTITY_LANES:].view(np.int64).astype(np.float64) for x in (left, right))
    dot, size = (a * b).sum(axis=1), np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
    cosine = np.divide(dot, size, out=np.zeros(len(a)), where=size > 0)
    return np.where((left == right).all(axis=1), 1.0, np.clip(cosine, 0.0, 1.0))


def to_text(prints: np.ndarray) -> list[str]:
    return [binascii.b2a_base64(row.tobytes(), newline=False).decode() for row in prints.astype("<u8")]


def from_text(codes: list[str | None]) -> np.ndarray:
    """The lanes of fingerprints written by ``to_text``; null is that of an empty text."""
    out = np.zeros((len(codes), IDENTITY_LANES + SKETCH_LANES), dtype=np.uint64)
    for i, code in enumerate(codes):
        if code is not None:
            out[i] = np.frombuffer(binascii.a2b_base64(code), dtype="<u8")
    return out


@pandas_udf(T.StringType())
def merge(left: pd.Series, right: pd.Series) -> pd.Series:
    """The fingerprint of the paragraphs of both; a null is an empty text."""
    return pd.Series(to_text(from_text(left.tolist()) + from_text(right.tolist())))


@pandas_udf(T.StringType())
def remove(whole: pd.Series, part: pd.Series) -> pd.Series:
    """The fingerprint left when the paragraphs of ``part``, which must be in ``whole``, are taken away."""
    return pd.Series(to_text(from_text(whole.tolist()) - from_text(part.tolist())))


@pandas_udf(T.DoubleType())
def alike(left: pd.Series, right: pd.Series) -> pd.Series:
    """Likeness of two columns of fingerprints."""
    return pd.Series(likeness(from_text(left.tolist()), from_text(right.tolist())))


def add_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint`` to every row; a null text is empty. A column of that name is replaced. No shuffle."""
    @pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        values = texts.fillna("").tolist()
        return pd.Series([code for i in range(0, len(values), 256) for code in to_text(fingerprints(values[i:i + 256]))])

    return docs.withColumn("fingerprint", of(F.col(text)))


def half_replaced(text: str, following: str) -> str:
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", partitions: int | None = None) -> DataFrame:
    """Fingerprint every text, its edited text and the next one, and compare them.

    The next document has the next smaller key (ties: by a hash of the text; null keys
    come last); after the last comes the first. The edited text's last half is
    replaced by the start of the next document. A lone document is its own next.
    An empty table gives an empty result; other columns are dropped.

    Keys are cut into ranges at approximate quantiles; each range is sorted in one task, and its
    first row is also sent to the range before, so texts move once.
    """
    spark = docs.sparkSession
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LEAST)).alias("__order"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    keys = base.select("__order")
    shares = [i / wanted for i in range(1, min(wanted, MOST_RANGES))]
    cuts = keys.agg(F.percentile_approx("__order", shares, 100_000)).first()[0] if shares else []
    bounds = np.unique(np.array(cuts or [], dtype=np.int64))

    def ranges(orders: pd.Series) -> np.ndarray:
        return np.searchsorted(bounds, orders.to_numpy(), "left")

    @pandas_udf("int")
    def range_of(orders: pd.Series) -> pd.Series:
        return pd.Series(ranges(orders), dtype="int32")

    # One row for each range that holds a key: bounded by the number of ranges.
    heads = {r.at: r.head for r in keys.groupBy(range_of("__order").alias("at")).agg(F.max("__order").alias("head")).collect()}
    held = sorted(heads, reverse=True)
    before = {heads[at]: held[i - 1] for i, at in enumerate(held)}

    @pandas_udf("array<int>")
    def places(orders: pd.Series) -> pd.Series:
        return pd.Series([[at, before[o]] if o in before else [at] for at, o in zip(ranges(orders).tolist(), orders.tolist())])

    sent = base.select("*", F.posexplode(places("__order")).alias("borrowed", "at"))
    dealt = sent.repartitionById(len(bounds) + 1, F.col("at")).sortWithinPartitions("borrowed", F.desc("__order"), F.xxhash64("text"))

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Documents of the range in order, and the first document that follows them."""
        followed = False
        for batch in batches:
            for borrowed, key_, text_ in zip(*(batch.column(c).to_pylist() for c in ("borrowed", "key", "text"))):
                if not followed:
                    yield key_, text_
                followed = bool(borrowed)

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Bounded lists of documents; each list begins with the last document of the one before."""
        held, size = [], 0
        for row in rows_of(batches):
            held.append(row)
            size += len(row[1])
            if size > SLICE_BYTES // 2 and len(held) > 1:
                yield held
                held, size = held[-1:], len(row[1])
        if len(held) > 1:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in groups(batches):
            texts = [t for _, t in held]
            own = fingerprints(texts)
            changed = [half_replaced(a, b) for a, b in zip(texts[:-1], texts[1:])]
            edited = fingerprints(changed)
            yield pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in held[:-1]], pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array(to_text(own[:-1])), pa.array(to_text(edited)),
                pa.array(likeness(own[:-1], edited)), pa.array(likeness(own[:-1], own[1:])),
            ], names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    out = dealt.select("borrowed", "key", "text").mapInArrow(run, "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumnRenamed("key", key)
