"""How far the sources of a language differ in their use of terms, in exact integers.

The distance of two sources sums a function of their smoothed shares over all kept
terms, also those that one or both never use. With a share at count zero for each
source, the sum over all terms is that of two unused terms times their number,
plus what each source's own terms change against the other's zero share, plus a
correction for terms that both use. The first two parts need only how many terms a
source uses how often. The third is a sparse product, accumulated by rows: the terms
are dealt in blocks, and in a block each source looks up its terms in the term-major
index and scatters into one dense accumulator over its peers. A task returns one sum
for each pair of sources, never a row for each pair of postings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.llm.scratch import Scratch
from hearthrate.llm.tokens import LOWER, byte_class, text_bytes, word_spans
from hearthrate.llm.words import hash_spans

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
# The scale of a share and what is added to each count.
SCALE_HIGH, SCALE_LOW, ADDED = 10_000, 100_000, 2
# Bytes of text and words counted at once, and postings of a block of terms.
PASS_BYTES = 2 << 20
PASS_WORDS = 500_000
BLOCK_ROWS = 100_000
# Tasks that the sources of one language are dealt over.
SALTS = 64

_LETTERS = byte_class((0x61, 0x7A), (0x80, 0xFF))


def count_terms(rows: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of (lang, source, text): occurrences, and documents that hold the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_bytes(batch.column("text"), PASS_BYTES):
                part = batch.slice(at, len(offsets) - 1)
                owner = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], names=["lang", "source"])
                group, owners = _codes(owner)
                yield from _count(LOWER[data], offsets, group, owners)

    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _codes(owner: pa.StructArray) -> tuple[np.ndarray, list[tuple[str, str]]]:
    found: dict[tuple[str, str], int] = {}
    code = [found.setdefault((o["lang"], o["source"]), len(found)) for o in owner.to_pylist()]
    return np.array(code, dtype=np.int64), list(found)


def _count(data: np.ndarray, offsets: np.ndarray, group: np.ndarray, owners: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
    """Counts of some texts, a bounded number of words at a time."""
    starts, ends, first = word_spans(data, offsets, _LETTERS)
    doc = np.repeat(np.arange(len(group)), np.diff(first))
    # Terms already counted of the text that the last piece ended in.
    begun, seen = -1, np.empty(0, dtype=np.uint64)
    for low in range(0, len(starts), PASS_WORDS):
        piece = slice(low, low + PASS_WORDS)
        terms, at, which = np.unique(hash_spans(data, starts[piece], ends[piece]), return_index=True, return_inverse=True)
        pair, n = np.unique(which * len(group) + doc[piece], return_counts=True)
        term, text = pair // len(group), pair % len(group)
        new = ~((text == begun) & np.isin(terms[term], seen))
        cell, into = np.unique(term * len(owners) + group[text], return_inverse=True)
        total, docs = np.zeros(len(cell), dtype=np.int64), np.zeros(len(cell), dtype=np.int64)
        np.add.at(total, into, n)
        np.add.at(docs, into, new)
        last = doc[piece][-1]
        here = terms[term[text == last]]
        seen = np.union1d(seen, here) if last == begun else here
        begun = last
        word = pa.array([data[s:e].tobytes() for s, e in zip(starts[piece][at].tolist(), ends[piece][at].tolist())], pa.binary()).cast(pa.string())
        of = pa.array(cell % len(owners))
        yield pa.RecordBatch.from_arrays([
            pa.array([o[0] for o in owners], pa.string()).take(of), pa.array([o[1] for o in owners], pa.string()).take(of),
            word.take(pa.array(cell // len(owners))), pa.array(total), pa.array(docs),
        ], names=["lang", "source", "term", "n", "docs"])


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)), in two steps that stay inside 64 bits up to 9e13 words."""
    part, whole = (count + ADDED) * SCALE_HIGH, total + ADDED * terms
    div = lambda a, b: F.call_function("div", a, b)
    return 1 + div(part, whole) * SCALE_LOW + div(part % whole * SCALE_LOW, whole)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def accumulate(term: np.ndarray, source: np.ndarray, p: np.ndarray, zero: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(source, corrections over all peers of higher number) from the postings of some terms.

    ``p`` is a posting's share, ``zero`` the share of each source at count zero.
    """
    order = np.lexsort((source, term))
    term, source, p = term[order], source[order], p[order]
    end = np.searchsorted(term, term, "right")
    rows = np.argsort(source, kind="stable")
    cuts = np.searchsorted(source[rows], np.arange(len(zero) + 1))
    for i in range(len(zero)):
        own = rows[cuts[i]:cuts[i + 1]]
        held = end[own] - own - 1
        later = np.arange(int(held.sum())) + np.repeat(own + 1 - (np.cumsum(held) - held), held)
        mine, theirs, peer = np.repeat(p[own], held), p[later], source[later]
        total = np.zeros(len(zero), dtype=np.int64)
        np.add.at(total, peer, _distance(mine, theirs) - _distance(mine, zero[peer]) - _distance(zero[i], theirs) + _distance(zero[i], zero[peer]))
        yield i, total


def shared_terms(postings: DataFrame) -> DataFrame:
    """(lang, source, peer, value): the corrections of both directions, from (lang, block, term, source, p, zero)."""
    def run(table: pa.Table) -> pa.Table:
        names, code = np.unique(table.column("source").to_numpy(zero_copy_only=False).astype(object), return_inverse=True)
        zero = np.zeros(len(names), dtype=np.int64)
        zero[code] = table.column("zero").to_numpy()
        term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
        out = {"source": [], "peer": [], "value": []}
        for i, total in accumulate(term, code, table.column("p").to_numpy(), zero):
            peer = np.flatnonzero(total)
            out["source"].append(np.full(len(peer), i))
            out["peer"].append(peer)
            out["value"].append(total[peer])
        flat = {k: np.concatenate(v) for k, v in out.items()}
        name = pa.array(names, pa.string())
        lang = pa.array([table.column("lang")[0].as_py()] * len(flat["value"]), pa.string())
        return pa.table({"lang": lang, "source": name.take(pa.array(flat["source"])), "peer": name.take(pa.array(flat["peer"])), "value": pa.array(flat["value"])})

    half = postings.groupBy("lang", "block").applyInArrow(run, "lang string, source string, peer string, value long")
    half = half.groupBy("lang", "source", "peer").agg(F.sum("value").alias("value"))
    return half.unionByName(half.select("lang", F.col("peer").alias("source"), F.col("source").alias("peer"), "value"))


def audit_sources(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
                  least_docs: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of every source of every language.

    Terms are runs of letters (with A-Z lower-cased) and characters beyond ASCII; a language keeps those in
    at least ``least_docs`` of its documents. Part ``pair`` has each other source of the language with the
    distance summed over all kept terms; part ``term`` the ``top`` kept terms that the source uses more than its
    language does. Ranks count from 1 by falling value, equal values by item.

    Null or empty ``text`` has no terms; null ``lang`` and ``source`` are the empty string, a language and a source
    like others. Repeated rows are documents of their own. A language without kept terms has pairs of
    value 0, one with a single source has no pairs; an empty table gives an empty result. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "audit")
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text"))
    of_term = Window.partitionBy("lang", "term")
    counts = count_terms(rows).withColumns({
        "held": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term), "once": (F.col("source") == F.min("source").over(of_term)).cast("long"),
    })
    kept = scratch.store(counts.where(F.col("held") >= least_docs).select("lang", "source", "term", "n", "lang_n", "once"))
    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.sum("once").alias("terms"))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "lang_total", "terms"])
    shares = {"zero": F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(1)}
    groups = scratch.store(groups.withColumns(shares))
    postings = kept.join(groups, ["lang", "source"]).withColumns({
        "p": share(F.col("n"), F.col("total"), F.col("terms")), "q": share(F.col("lang_n"), F.col("lang_total"), F.col("terms")),
    })
    pairs = _ranked(_pairs(postings, groups, kept.count()), "pair")
    terms = postings.where("p > q").select("lang", "source", F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    return pairs.unionByName(_ranked(terms, "term").where(F.col("rank") <= top))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _pairs(postings: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    """(lang, source, item, value) of all pairs of sources; these pairs are the result itself."""
    # How many terms a source uses with each share: at most about the root of twice its words.
    uses = postings.groupBy("lang", "source", "p").agg(F.count("*").alias("n")).groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("uses"))
    # Languages may be few and large: one side is dealt over salts, the other, one short row a source, goes to each.
    left = groups.join(uses, ["lang", "source"], "left").withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS)))
    right = groups.select("lang", F.col("source").alias("peer"), F.col("zero").alias("other"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    both = left.join(right, ["lang", "salt"]).where("source <> peer")
    unused = distance(F.col("zero"), F.col("other"))
    change = F.aggregate("uses", F.lit(0).cast("long"), lambda a, u: a + u["n"] * (distance(u["p"], F.col("other")) - F.col("unused")))
    both = both.withColumn("unused", unused).withColumn("change", F.coalesce(change, F.lit(0)))
    blocks = max(1, -(-size // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block")
    corrections = shared_terms(postings.select("lang", block, "term", "source", "p", "zero"))
    parts = both.select("lang", "source", "peer", (F.col("terms") * F.col("unused") + F.col("change")).alias("value")).unionByName(
        both.select("lang", F.col("peer").alias("source"), F.col("source").alias("peer"), F.col("change").alias("value"))).unionByName(corrections)
    return parts.groupBy("lang", "source", F.col("peer").alias("item")).agg(F.sum("value").alias("value"))
