"""Near-duplicates by one-permutation MinHash, confirmed on the full shingle sets.

One hash of each shingle fills the slot its leading bits name; empty slots are
filled by optimal densification: each draws other slots, in an order all
documents share, until it meets a filled one. Bands of slots are buckets.

Documents with equal sets are one class from the start. In a bucket, candidate
edges form stars: a centre against all members of other components. Centres
come from the smallest components, leave the bucket once compared, and their
number grows from round to round; a bucket is done when its members are one
component. So members already connected are never paired, and every pair of a
bucket that could connect two components is compared: no cap, no lost link.
After the first round exact bounds come before any pair: of its shingles a member
can share with others only those that some other open member holds too. Members
that cannot reach the needed share with these leave their bucket unpaired; for
pairs the bound is taken over classes of shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from hearthrate.llm.components import components
from hearthrate.llm.scratch import Scratch
from hearthrate.llm.words import Words, mix, passes, runs

# 60 bands of 6 slots: documents that share 75 % meet in some band with a chance of 1 - 8e-6, those
# that share 30 % in one of a thousand bands, so a passage many documents hold fills no bucket.
SLOTS = 360
ROWS = 6
_BANDS = SLOTS // ROWS
_DRAWS = 4096
# The number of centres of a bucket grows by this factor each round.
GROWTH = 16
# Classes of shingles, by their hash, whose counts bound what two documents can share.
CLASSES = 32

# Draw t of slot s: the slot it looks at; the same for all documents.
_ORDER = (mix(np.arange(_DRAWS * SLOTS, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)) % np.uint64(SLOTS)).astype(np.int64).reshape(_DRAWS, SLOTS)
_BAND_SALT = mix(np.arange(1, _BANDS + 1, dtype=np.uint64))


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words, or of all its words if fewer."""
    hashes, at = runs(words, size)
    cuts = np.searchsorted(at, words.first)
    for i in range(len(words)):
        n = words.first[i + 1] - words.first[i]
        if n >= size:
            yield np.unique(hashes[cuts[i]:cuts[i + 1]])
        elif n:
            whole = np.array([n], dtype=np.uint64)
            for k in range(words.first[i], words.first[i + 1]):
                whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + words.hashes[k:k + 1])
            yield whole
        else:
            yield np.empty(0, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """SLOTS values of a non-empty sorted set of hashes."""
    slot, first = np.unique((((shingles >> np.uint64(32)) * np.uint64(SLOTS)) >> np.uint64(32)).astype(np.int64), return_index=True)
    values = np.zeros(SLOTS, dtype=np.uint64)
    filled = np.zeros(SLOTS, dtype=bool)
    values[slot], filled[slot] = shingles[first], True
    source = np.arange(SLOTS)
    empty = np.flatnonzero(~filled)
    for t in range(0, _DRAWS, 64):
        if not len(empty):
            break
        drawn = _ORDER[t:t + 64, empty]
        hit = filled[drawn]
        found = hit.any(axis=0)
        source[empty[found]] = drawn[hit.argmax(axis=0)[found], np.flatnonzero(found)]
        empty = empty[~found]
    if len(empty):  # about one slot in ten million of a set with a single filled one
        source[empty] = slot[0]
    return values[source]


def bands(shingles: np.ndarray) -> np.ndarray:
    rows = signature(shingles).reshape(_BANDS, ROWS)
    h = _BAND_SALT.copy()
    for r in range(ROWS):
        h = mix(h ^ rows[:, r])
    return h.view(np.int64)


def sketch(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, n_shingles, d1, d2, bands) of every row: the set's size and 128-bit digest, and its buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in passes(batch.column("text"), lower=True):
                sets = list(shingle_sets(words, size))
                digests = np.array([np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), dtype=np.int64) for s in sets]).reshape(-1, 2)
                buckets = [bands(s) if len(s) else np.empty(0, dtype=np.int64) for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(b) for b in buckets])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(words.at, len(words)),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(buckets))),
                ], names=["id", "n_shingles", "d1", "d2", "bands"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "id long, n_shingles long, d1 long, d2 long, bands array<long>")


def _full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(id, shingles) of the wanted documents (id, d1, d2), from their whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in passes(batch.column("text"), lower=True):
                sets = list(shingle_sets(words, size))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(words.at, len(words)), pa.ListArray.from_arrays(offsets, values)], names=["id", "shingles"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    return rows.join(wanted, "id", "left_semi").mapInArrow(run, "id long, shingles array<long>")


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of all pairs: whether ``percent`` or more of the union is common."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")).cast("long"))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return both.groupBy("a", "b").agg(F.max(F.col("common") * 100 >= union * percent).alias("linked"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 75) -> DataFrame:
    """One row for each row of ``docs``: ``key``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents link when their sets of shingles (``size`` lower-cased words; all
    words, if fewer) share ``percent`` or more of their union. ``component_id``
    is the smallest key reachable over links; ``kept`` marks that document. Texts
    that are null or have no word have an empty set and are alone. Rows without
    key are alone, with a null component, and not kept. Keys should be unique:
    rows that repeat a key and text are one document, and rows that repeat a key
    with other texts keep a row and a component each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    sketches = scratch.store(sketch(docs, key, text, size))
    real = sketches.where("n_shingles > 0 and id is not null")
    classes = real.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    spots = scratch.store(classes.select("id", "n", F.explode("bands").alias("bucket")))
    shared = spots.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket")
    members = scratch.store(spots.join(shared, "bucket").select("bucket", "id", "n", F.col("id").alias("part")))
    scratch.drop(spots)
    labels = None
    if not members.isEmpty():
        sets = scratch.store(_full_sets(docs, members.select("id").distinct(), key, text, size))
        labels = _connect(members, sets, percent, scratch)
        scratch.drop(sets)
    first = real.groupBy("d1", "d2").agg(F.min("id").alias("first"))
    rows = sketches.select("id", "n_shingles", "d1", "d2")
    alone = rows.where("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component"))
    joined = rows.where("n_shingles > 0 and id is not null").join(first, ["d1", "d2"])
    if labels is None:
        linked = joined.select("id", "n_shingles", F.col("first").alias("component"))
    else:
        linked = joined.join(labels.withColumnRenamed("node", "first"), "first", "left").select("id", "n_shingles", F.coalesce("component", "first").alias("component"))
    return linked.unionByName(alone).select(
        F.col("id").alias(key), "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def _shared(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, held, classes): how many of its shingles each member has in common with any other member, in all and by class of hash."""
    ids = members.select("id").distinct()
    shingles = sets.join(ids, "id", "left_semi").select("id", F.explode("shingles").alias("shingle"))
    # One row for each shingle of two or more members; a shingle of a single one needs no row further on.
    common = shingles.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1").select("shingle")
    held = shingles.join(common, "shingle", "left_semi").withColumn("class", F.col("shingle").bitwiseAND(F.lit(CLASSES - 1)))
    counts = F.array(*[F.sum((F.col("class") == k).cast("int")).cast("int") for k in range(CLASSES)])
    none = F.array(*[F.lit(0)] * CLASSES)
    return ids.join(held.groupBy("id").agg(F.count("*").alias("held"), counts.alias("classes")), "id", "left").select(
        "id", F.coalesce("held", F.lit(0)).alias("held"), F.coalesce("classes", none).alias("classes"))


def _may_link(members: DataFrame, percent: int) -> DataFrame:
    """The members that could still link with one of another component in their bucket, by sizes and shared shingles alone.

    Two documents have at most the smaller ``held`` in common. So a partner of ``n`` shingles needs
    ``(100 + percent) * held >= percent * (own n + n)``, and ``n`` is at least ``percent`` of the own size.
    """
    sizes = members.groupBy("bucket", "part").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    # The smallest size of another component: that of the first two components by least size decides.
    order = Window.partitionBy("bucket").orderBy("least", "part")
    first = sizes.withColumn("place", F.row_number().over(order)).where("place <= 2").groupBy("bucket").agg(
        F.min_by("part", "place").alias("first_part"), F.min("least").alias("first_least"), F.max("least").alias("second_least"))
    other = F.when(F.col("part") == F.col("first_part"), F.col("second_least")).otherwise(F.col("first_least"))
    room = F.col("held") * (100 + percent) - F.col("n") * percent
    smallest = F.greatest(other * percent, F.ceil(F.col("n") * percent / 100) * percent)
    return members.join(first, "bucket").where(room >= smallest).drop("first_part", "first_least", "second_least")


def _open(members: DataFrame) -> DataFrame:
    """The members of buckets that still hold more than one component."""
    open_ = members.groupBy("bucket").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high").select("bucket")
    return members.join(open_, "bucket", "left_semi")


def _connect(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame | None:
    """Components (node, component) of all links among bucket mates; None without links."""
    links, labels, tested, centres_per_bucket = None, None, None, 1
    members, bounded = scratch.store(_open(members)), False
    while not members.isEmpty():
        sizes = members.groupBy("bucket", "part").agg(F.count("*").alias("size"))
        order = Window.partitionBy("bucket").orderBy("size", "part", "id")
        ranked = members.join(sizes, ["bucket", "part"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= centres_per_bucket)
        known = ["id", "n", "part", *(["held", "classes"] if bounded else [])]
        centres = scratch.store(ranked.select("bucket", *[F.col(c).alias(f"c_{c}") for c in known]))
        alike = (F.least("n", "c_n") * 100 >= F.greatest("n", "c_n") * percent) & (F.col("part") != F.col("c_part"))
        if bounded:
            enough = (F.col("n") + F.col("c_n")) * percent
            common = F.aggregate(F.zip_with("classes", "c_classes", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x)
            alike = alike & (F.least("held", "c_held") * (100 + percent) >= enough) & (common * (100 + percent) >= enough)
        pairs = members.join(centres, "bucket").where(alike).select(F.least("id", "c_id").alias("a"), F.greatest("id", "c_id").alias("b")).distinct()
        pairs = scratch.store(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = scratch.store(_compare(pairs, sets, percent).where("linked").select("a", "b"))
        tested = pairs if tested is None else tested.union(pairs)
        rest = members.join(centres.select("bucket", F.col("c_id").alias("id")), ["bucket", "id"], "left_anti").select("bucket", "id", "n", "part")
        if not found.isEmpty():
            links = found if links is None else links.union(found)
            labels = components(links, scratch)
            rest = rest.drop("part").join(labels.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", "n", F.coalesce("component", "id").alias("part"))
        old, rest = members, scratch.store(_open(rest))
        scratch.drop(old, centres)
        if rest.isEmpty():
            break
        # Each step is stored, as the next one reads it twice.
        rated = scratch.store(rest.join(_shared(rest, sets), "id"))
        able = scratch.store(_may_link(rated, percent))
        members, bounded = scratch.store(_open(able)), True
        scratch.drop(rest, rated, able)
        centres_per_bucket *= GROWTH
    return labels
