"""Exact substring dedup by fixed-block anchors.

A repeat of ``window`` words holds a whole block of ``(window + 1) // 2`` words
that is aligned in the document it repeats. So the non-overlapping blocks of every
document are indexed, every rolling run of that length probes them, and a hit anchors a
possible repeat. Around the anchors, and nowhere else, the windows of
``window`` words are compared by 128-bit hashes with those of all other anchored documents;
windows found in a smaller document are merged into maximal repeats, whose
words are removed.

Both comparisons send packed hashes instead of rows: a task sorts its own first,
answers what it can itself, and sends a hash once however many of its
documents hold it. A passage that a third of all documents share reaches its partition
once per task, and no pairs of documents are made.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hearthrate.llm.scratch import Scratch
from hearthrate.llm.words import Words, mix, passes, runs

# Hashes a task holds before it sorts and sends them.
FLUSH = 4_000_000
_PACKED = "part int, docs binary, counts binary, keys binary, flags binary, local boolean"
_SECOND = np.uint64(0xA0761D6478BD642F)


class Packer:
    """Collects (key, document, flag) and turns them into packed rows for the partitions.

    ``width``: bytes of a key kept; ``first_only``: only documents after a key's
    smallest get an answer, otherwise all documents of a shared key do.
    """

    def __init__(self, parts: int, width: int, first_only: bool):
        self.parts, self.width, self.first_only = parts, width, first_only
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, docs: np.ndarray, flags: np.ndarray) -> None:
        """``keys``: one or two 64-bit columns."""
        self.held.append((keys, docs, flags))
        self.size += len(docs)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.size:
            return
        keys, docs, flags = (np.concatenate([h[k] for h in self.held]) for k in range(3))
        self.held, self.size = [], 0
        keys, docs, flags, starts, shared = grouped(keys, docs, flags)
        # A key of several documents here is sent with the smallest, marked 2: a hit wherever else it is.
        multi = np.logical_or.reduceat(shared, starts)
        sent_flags = np.where(multi, 2, np.maximum.reduceat(flags, starts)).astype(np.uint8)
        yield from self._packed(keys[starts], docs[starts], sent_flags, local=False)
        answer = shared.copy()
        if self.first_only:
            answer &= docs != np.repeat(docs[starts], np.diff(np.append(starts, len(docs))))
        if answer.any():
            yield from self._packed(keys[answer], docs[answer], np.zeros(answer.sum(), dtype=np.uint8), local=True)

    def _packed(self, keys: np.ndarray, docs: np.ndarray, flags: np.ndarray, local: bool) -> Iterator[pa.RecordBatch]:
        # Local answers only travel to be united, spread by document.
        part = ((mix(docs.view(np.uint64)) if local else keys[:, 0]) % np.uint64(self.parts)).astype(np.int64)
        order = np.lexsort((docs, part))
        keys, docs, flags, part = keys[order], docs[order], flags[order], part[order]
        cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
        for lo in range(0, len(cuts) - 1, 256):
            columns: list[list] = [[], [], [], [], []]
            for i, j in zip(cuts[lo:lo + 256], cuts[lo + 1:lo + 257]):
                begins = np.flatnonzero(np.diff(docs[i:j], prepend=docs[i] - 1))
                columns[0].append(int(part[i]))
                columns[1].append(squeeze(np.diff(docs[i:j][begins], prepend=0)))
                columns[2].append(squeeze(np.diff(np.append(begins, j - i)).astype(np.int32)))
                columns[3].append(pack(keys[i:j], self.width))
                columns[4].append(squeeze(flags[i:j]))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array([local] * len(columns[0]))],
                names=["part", "docs", "counts", "keys", "flags", "local"])


def squeeze(numbers: np.ndarray) -> bytes:
    """Small differences, counts and flags are mostly zero bytes."""
    return zlib.compress(numbers.tobytes(), 1)


def spread_out(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=kind)


def pack(keys: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(len(keys), -1)[:, :width].tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    columns = -(-width // 8)
    out = np.zeros((len(data) // width, columns * 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(-1, width)
    return out.view(np.uint64).reshape(-1, columns)


def grouped(keys: np.ndarray, docs: np.ndarray, flags: np.ndarray):
    """Distinct (key, document) in order with their largest flag, where each key starts, and whether its key has several documents."""
    order = np.lexsort((docs, *keys.T[::-1]))
    keys, docs, flags = keys[order], docs[order], flags[order]
    new_key = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
    new = new_key.copy()
    new[1:] |= docs[1:] != docs[:-1]
    at = np.flatnonzero(new)
    flags = np.maximum.reduceat(flags, at)
    keys, docs, new_key = keys[at], docs[at], new_key[at]
    starts = np.flatnonzero(new_key)
    sizes = np.diff(np.append(starts, len(docs)))
    return keys, docs, flags, starts, np.repeat(sizes > 1, sizes)


def _entries(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(keys, documents, flags, local) of each packed row."""
    for batch in batches:
        for row in batch.to_pylist():
            docs = np.repeat(np.cumsum(spread_out(row["docs"], np.int64)), spread_out(row["counts"], np.int32))
            yield unpack(row["keys"], width), docs, spread_out(row["flags"], np.uint8), row["local"]


def _answers(packed: DataFrame, parts: int, width: int, first_only: bool) -> DataFrame:
    """(doc_id, keys): for each document the keys that got a hit, packed to 8 bytes at most."""
    kept = min(width, 8)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, done = [], []
        for keys, docs, flags, local in _entries(batches, width):
            (done if local else asked).append((keys, docs, flags))
        if asked:
            k, d, f, starts, shared = grouped(*(np.concatenate([a[i] for a in asked]) for i in range(3)))
            sizes = np.diff(np.append(starts, len(d)))
            if first_only:
                hit = shared & (d != np.repeat(d[starts], sizes))
            else:
                best = np.repeat(np.maximum.reduceat(f, starts), sizes)
                hit = (best == 2) | (shared & (best == 1))
            done.append((k[hit], d[hit], f[hit]))
        if done:
            k, d = (np.concatenate([a[i] for a in done]) for i in range(2))
            if len(d):
                yield from Packer(parts, kept, first_only)._packed(k[:, :1], d, np.zeros(len(d), dtype=np.uint8), local=True)

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(keys, docs) for keys, docs, _, _ in _entries(batches, kept)]
        if not found:
            return
        k, d = (np.concatenate([a[i] for a in found]) for i in range(2))
        order = np.argsort(d, kind="stable")
        k, d = k[order], d[order]
        cuts = np.append(np.flatnonzero(np.append(True, d[1:] != d[:-1])), len(d))
        for lo in range(0, len(cuts) - 1, 1000):
            spans = list(zip(cuts[lo:lo + 1000], cuts[lo + 1:lo + 1001]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(d[i]) for i, _ in spans], pa.int64()), pa.array([pack(k[i:j], kept) for i, j in spans], pa.binary())],
                names=["doc_id", "keys"])

    judged = packed.repartitionById(parts, F.col("part")).mapInArrow(judge, _PACKED)
    return judged.repartitionById(parts, F.col("part")).mapInArrow(unite, "doc_id long, keys binary")


def joined_words(words: Words, kept: np.ndarray) -> list[bytes]:
    """For each text its kept words joined by one space."""
    starts, ends, doc = words.starts[kept], words.ends[kept], words.doc()[kept]
    edge = np.zeros(len(words.data) + 1, dtype=np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    take = np.cumsum(edge)[:-1] > 0
    out = words.data.copy()
    more = np.flatnonzero(doc[1:] == doc[:-1])
    out[ends[more]], take[ends[more]] = 0x20, True
    # Words of a text lie between its first word and the next text's first word.
    first = np.append(words.starts, len(words.data))[words.first]
    before = np.concatenate([[0], np.cumsum(take)])[first]
    body = out[take].tobytes()
    return [body[i:j] for i, j in zip(before[:-1], before[1:])]


def block_keys(words: Words, block: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, at = runs(words, block)
    return (hashes & np.uint64((1 << bits) - 1))[:, None], at


def window_keys(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every window."""
    first, at = runs(words, window)
    h = np.zeros(len(first), dtype=np.uint64)
    for j in range(window):
        h = mix(h ^ (words.hashes[at + j] * _SECOND + np.uint64(j)))
    return np.stack([first, h], axis=1), at


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 13, parts: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_words``, ``n_removed`` and ``kept_sha256``.

    Removed are the words covered by a window of ``window`` words whose sequence
    also starts in a document of smaller key; windows are judged on the input.
    ``kept_sha256`` is of the kept words joined by one space. Null texts are empty. Rows
    without key lose nothing and take nothing from others. Rows that repeat a key do not
    count as smaller than each other. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "repeats")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    block, bits = (window + 1) // 2, min(40 + parts.bit_length() - 1, 64)
    # Bytes of an anchor's key: all its bits must travel, as answers are compared with whole keys.
    width = -(-bits // 8)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in passes(batch.column("text")):
                texts = joined_words(words, np.ones(len(words.hashes), dtype=bool))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(words.at, len(words)), pa.array(words.counts().astype(np.int64)), pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
                    names=["doc_id", "n_words", "whole"])

    def packing(make: Callable[[], Packer], fill: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packer = make()
            for batch in batches:
                ids = batch.column("doc_id").to_numpy()
                for words in passes(batch.column("text")):
                    fill(packer, words, ids[words.at:words.at + len(words)], batch)
                    if packer.size > FLUSH:
                        yield from packer.rows()
            yield from packer.rows()

        return run

    def probe(packer: Packer, words: Words, ids: np.ndarray, _: pa.RecordBatch) -> None:
        keys, at = block_keys(words, block, bits)
        doc = words.doc()[at]
        # Blocks start at every multiple of their length from the first word.
        aligned = (at - words.first[doc]) % block == 0
        packer.add(keys, ids[doc], aligned.astype(np.uint8))

    def confirm(packer: Packer, words: Words, ids: np.ndarray, batch: pa.RecordBatch) -> None:
        hit = anchored(words, batch.column("keys"), lambda w: block_keys(w, block, bits), width)
        keys, at = window_keys(words, window)
        reach = np.concatenate([[0], np.cumsum(hit)])
        near = reach[np.minimum(at + window - block + 1, len(hit))] > reach[at]
        packer.add(keys[near], ids[words.doc()[at[near]]], np.zeros(near.sum(), dtype=np.uint8))

    def anchored(words: Words, keys: pa.Array, hashes: Callable, width: int) -> np.ndarray:
        """Marks each word at which a run starts whose key is among its document's ``keys``."""
        own, at = hashes(words)
        doc, mark = words.doc()[at], np.zeros(len(words.hashes), dtype=bool)
        cuts = np.searchsorted(doc, np.arange(len(words) + 1))
        for i in range(len(words)):
            packed = keys[words.at + i].as_py()
            if packed:
                known = unpack(packed, width)[:, 0]
                mark[at[cuts[i]:cuts[i + 1]]] = np.isin(own[cuts[i]:cuts[i + 1], 0], known)
        return mark

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in passes(batch.column("text")):
                starts = anchored(words, batch.column("keys"), lambda w: window_keys(w, window), 8)
                edge = np.zeros(len(words.hashes) + window, dtype=np.int64)
                np.add.at(edge, np.flatnonzero(starts), 1)
                np.add.at(edge, np.flatnonzero(starts) + window, -1)
                removed = np.cumsum(edge)[:len(words.hashes)] > 0
                everything = joined_words(words, np.ones(len(removed), dtype=bool))
                left = joined_words(words, ~removed)
                gone = np.diff(np.concatenate([[0], np.cumsum(removed)])[words.first])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(words.at, len(words)), pa.array([hashlib.sha256(t).hexdigest() for t in everything]),
                     pa.array(gone), pa.array([hashlib.sha256(t).hexdigest() for t in left])],
                    names=["doc_id", "whole", "gone", "left_sha256"])

    sized = scratch.store(rows.mapInArrow(whole, "doc_id long, n_words long, whole string"))
    # A copy of a smaller document, long enough for a window, goes whole; no more need be known of it.
    first = sized.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull()).groupBy("whole").agg(F.min("doc_id").alias("first"))
    judged = sized.join(first, "whole", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    probing = rows.where("doc_id is not null").mapInArrow(packing(lambda: Packer(parts, width, False), probe), _PACKED)
    anchors = scratch.store(_answers(probing, parts, width, False))
    del probing
    scratch.release_shuffles()
    own = judged.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.col("copy").cast("int")).alias("copied")).where("copied = 0").select("doc_id")
    flagged = scratch.store(rows.join(anchors.join(own, "doc_id"), "doc_id"))
    scratch.drop(anchors)
    scratch.release_shuffles()
    confirming = flagged.mapInArrow(packing(lambda: Packer(parts, 16, True), confirm), _PACKED)
    repeats = scratch.store(_answers(confirming, parts, 16, True))
    del confirming
    scratch.release_shuffles()
    shorter = flagged.drop("keys").join(repeats, "doc_id").mapInArrow(cut, "doc_id long, whole string, gone long, left_sha256 string").dropDuplicates(["doc_id", "whole"])
    out = judged.join(shorter, ["doc_id", "whole"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("doc_id").alias(key), "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("copy"), F.lit(empty)).otherwise(F.coalesce("left_sha256", "whole")).alias("kept_sha256"),
    )
