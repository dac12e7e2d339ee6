"""Importance resampling towards a target distribution, over hashed word n-grams.

Every n-gram falls into a bucket. The logarithm of how much more often the target
texts use a bucket than the documents do is its gain; a document's weight is the
sum over its n-grams. Seeded Gumbel noise on the weights turns the highest scores
into a draw without replacement in proportion to the weights.

Texts are read twice, to count buckets and to sum gains; what lies between is one
number per bucket. The drawn share is ranked in bins of scores, each sorted on its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F, types as T

from hearthrate.llm.grams import GramTable, grams
from hearthrate.llm.scratch import Scratch
from hearthrate.llm.tokens import LOWER, byte_class, text_bytes

BUCKETS = 10_000
MOST_WORDS = 3
PERCENT = 5
LEAST_WORDS = 20
SEED = 42
# Bytes of text handled at once, and rows of a bin that is ranked in one task.
PASS_BYTES = 1 << 20
BIN_ROWS = 1_000_000

# Digits, lower-case letters, and all bytes of characters beyond ASCII.
_LETTERS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def bucket_counts(texts: DataFrame, text: str, buckets: int = BUCKETS) -> np.ndarray:
    """The occurrences of n-grams in every bucket over all texts; a task sends one row for each bucket it met."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, data, offsets in text_bytes(batch.column("text"), PASS_BYTES):
                for part in grams(LOWER[data], offsets, _LETTERS, MOST_WORDS)[1]:
                    table = GramTable(part)
                    np.add.at(total, table.buckets(buckets)[table.used], table.count[table.used])
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], names=["bucket", "n"])

    rows = texts.select(F.col(text).alias("text")).mapInArrow(run, "bucket int, n long")
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed bucket shares, target over source, rounded down."""
    k = len(source)
    above = (target + 1).astype(float) * float(source.sum() + k)
    below = (source + 1).astype(float) * float(target.sum() + k)
    return np.array([math.floor(1000 * math.log(r)) for r in (above / below).tolist()], dtype=np.int64)


def add_weights(docs: DataFrame, gains: np.ndarray, key: str, text: str) -> DataFrame:
    """(key, n_words, n_features, weight) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_bytes(batch.column("text"), PASS_BYTES):
                words, parts = grams(LOWER[data], offsets, _LETTERS, MOST_WORDS)
                features, weight = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
                for part in parts:
                    table = GramTable(part)
                    gain = gains[table.buckets(len(gains))]
                    features += np.bincount(part.doc, minlength=len(words))
                    np.add.at(weight, part.doc, gain[table.slots])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, len(words)), pa.array(words.astype(np.int64)), pa.array(features), pa.array(weight)],
                    names=["key", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["key"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    return rows.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Words are runs of digits, letters and characters beyond ASCII, with A-Z lower-cased;
    features are all runs of 1 to 3 of them, repeats counted. Of the N documents with at
    least ``least_words`` words the ``percent * N // 100`` highest scores are drawn, ties to
    the smaller key, and numbered from 1; all others have a null rank.

    A null or empty text has no features and weight 0; it is never drawn. A null key draws
    the noise of an empty one and comes last among equal scores. Rows that repeat a key
    are scored and drawn each for itself, in any order among themselves where all else
    is equal. Without targets all shares are smoothed from nothing; an empty ``docs`` gives
    an empty result. Other columns are not read; ``sampled`` brings them to the drawn rows.
    """
    scratch = Scratch(docs.sparkSession, "resample")
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    weighed = add_weights(docs, gains, key, text)
    draw = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256), 1, 8)
    uniform = (F.conv(draw, 16, 10).cast("long") + 0.5) / 4294967296.0
    scored = scratch.store(weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform)))))
    return rank_highest(scored, percent, least_words).withColumnRenamed("key", key)


def rank_highest(scored: DataFrame, percent: int, least_words: int, bin_rows: int = BIN_ROWS) -> DataFrame:
    """Add ``rank`` to (key, n_words, ..., score).

    Sketched quantiles cut the scores into bins of about ``bin_rows`` rows, and exact counts
    of the bins say where each begins. Bins that begin beyond the draw are not sorted.
    """
    able = scored.where(F.col("n_words") >= least_words)
    n = able.count()
    drawn = percent * n // 100
    none = F.lit(None).cast("long").alias("rank")
    if drawn == 0:
        return scored.select("*", none)
    shares = [1 - i * bin_rows / n for i in range(1, math.ceil(drawn / bin_rows) + 1)]
    # A few bins are always asked for, so that a draw below one bin does not sort all rows.
    shares = sorted({s for s in shares if s > 0} | {1 - min(1.0, 1.2 * drawn / n)})
    cuts = sorted(set(able.select(F.percentile_approx("score", shares, max(10_000, 20 * n // bin_rows)).alias("q")).first()["q"]))
    binned = Bucketizer(splits=[-math.inf, *map(float, cuts), math.inf], inputCol="value", outputCol="bin").transform(
        able.withColumn("value", F.col("score").cast("double"))).drop("value")
    counts = {r["bin"]: r["count"] for r in binned.groupBy("bin").count().collect()}
    begin, offsets = 0, {}
    for b in sorted(counts, reverse=True):
        if begin < drawn:
            offsets[b] = begin
        begin += counts[b]
    order = Window.partitionBy("bin").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    start = F.element_at(F.create_map(*[F.lit(x) for pair in offsets.items() for x in pair]), F.col("bin"))
    place = F.row_number().over(order).cast("long") + start
    lowest = min(offsets)
    high = binned.where(F.col("bin") >= lowest).withColumn("rank", place).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    low = binned.where(F.col("bin") < lowest).select("*", none).unionByName(
        scored.where(F.col("n_words") < least_words).select("*", F.lit(None).cast("double").alias("bin"), none))
    return high.unionByName(low).drop("bin")


def sampled(docs: DataFrame, ranked: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key was drawn, whole; rows without key are left to the caller."""
    return docs.join(ranked.where("rank is not null").select(key).distinct(), key, "left_semi")
