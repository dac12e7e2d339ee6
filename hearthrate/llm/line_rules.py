"""Quality of documents from their lines: fixed counts first, then a labelling of lines as content or boilerplate.

Lines are described by their form alone: length, capitals, digits, marks, words said twice, how it ends,
whether it repeats an earlier one. A linear-chain conditional random field, fitted on a bounded sample of
documents labelled good or bad, decodes each text's lines by Viterbi; a document whose words lie
mostly in content lines is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hearthrate.llm.chain import Chain, fit_chain
from hearthrate.llm.tokens import byte_class, text_bytes
from hearthrate.llm.words import Words, hash_spans, mix, runs, split

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20
# A document stays if this share of its words or more lies in content lines.
LEAST_CONTENT = 0.5
# The model is fitted on about so many labelled documents of each quality, drawn by a hash of their key,
# and on at most so many runs of so many lines, evenly spaced, of each.
DRAWN = 2_000
RUNS = 8
RUN_LINES = 32
PASS_BYTES = 1 << 20

_SYMBOL = byte_class(*[(ord(c), ord(c)) for c in SYMBOLS]).astype(np.uint8)
_DIGIT = byte_class((0x30, 0x39)).astype(np.uint8)
_UPPER = byte_class((0x41, 0x5A)).astype(np.uint8)
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)).astype(np.uint8)
_CHARACTER = byte_class((0x00, 0x08), (0x0E, 0x1F), (0x21, 0x7F), (0xC0, 0xFF)).astype(np.uint8)
_MARK = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)).astype(np.uint8)
_SHOUT = byte_class((0x21, 0x21)).astype(np.uint8)
_STOP = byte_class(*[(ord(c), ord(c)) for c in ".!?:;\"')"])

# Upper edges of the bins a measure of a line falls into.
_BINS = {
    "words": (2, 4, 9, 21), "word_length": (3, 5, 8, 12), "symbol_words": (0.001, 0.05, 0.2, 0.5), "digits": (0.001, 0.05, 0.3),
    "capitals": (0.001, 0.1, 0.3, 0.7), "marks": (0.001, 0.03, 0.1, 0.25), "shouts": (0.001, 0.02), "stutter": (0.001, 0.1, 0.4), "letters": (0.5, 0.75, 0.95),
}
_FLAGS = ("opens_capital", "ends_stop", "repeats_earlier")
N_FEATURES = 1 + sum(len(e) + 1 for e in _BINS.values()) + len(_FLAGS)


@dataclass
class Lines:
    """The lines with a word of some texts, and each text's counts."""

    doc: np.ndarray
    number: np.ndarray
    per_doc: np.ndarray
    of_all: np.ndarray
    words: np.ndarray
    features: np.ndarray
    hashes: np.ndarray
    counts: dict[str, np.ndarray]


def _repeated_words(words: Words) -> np.ndarray:
    """For each text its words inside a window of ``WINDOW`` words found twice or more in it."""
    h, at = runs(words, WINDOW)
    doc = words.doc()
    _, which, times = np.unique(mix(h ^ mix(doc[at].astype(np.uint64))), return_inverse=True, return_counts=True)
    again = at[times[which] > 1]
    edge = np.zeros(len(doc) + 1, dtype=np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=len(words))


def read_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    n = len(offsets) - 1
    words = split(data, offsets)
    breaks = np.flatnonzero(data == 0x0A)
    lines = np.bincount(np.searchsorted(offsets, breaks, "right") - 1, minlength=n) + 1
    first = np.cumsum(lines) - lines
    starts, ends = np.empty(int(lines.sum()), dtype=np.int64), np.empty(int(lines.sum()), dtype=np.int64)
    inner = np.ones(len(starts), dtype=bool)
    inner[first] = False
    starts[first], starts[inner] = offsets[:-1], breaks + 1
    inner[:] = True
    inner[first + lines - 1] = False
    ends[first + lines - 1], ends[inner] = offsets[1:], breaks
    word_at = np.searchsorted(words.starts, starts)
    held = np.searchsorted(words.starts, ends) - word_at
    real = np.flatnonzero(held > 0)
    doc = np.repeat(np.arange(n), lines)[real]
    number = real - first[doc]
    starts, ends, held, word_at = starts[real], ends[real], held[real], word_at[real]
    # Between two lines with words lie only blanks and breaks, which belong to no class of bytes.
    total = lambda table: np.add.reduceat(table[data], starts, dtype=np.int64) if len(starts) else np.zeros(0, dtype=np.int64)
    hashes = hash_spans(data, starts, ends)
    _, earliest, same = np.unique(mix(hashes ^ mix(doc.astype(np.uint64))), return_index=True, return_inverse=True)
    repeats = earliest[same] < np.arange(len(doc))
    chars, symbols = total(_CHARACTER), total(_SYMBOL)
    if len(starts):
        marked = np.add.reduceat((np.add.reduceat(_SYMBOL[data], words.starts, dtype=np.int64) > 0).astype(np.int64), word_at)
        same_word = np.concatenate([[False], words.hashes[1:] == words.hashes[:-1]])
        same_word[word_at] = False
        stutter = np.add.reduceat(same_word.astype(np.int64), word_at)
        opening, closing = data[words.starts[word_at]], data[words.ends[word_at + held - 1] - 1]
    else:
        marked, stutter, opening, closing = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.uint8)
    letters = total(_LETTER)
    some, many = np.maximum(chars, 1), np.maximum(letters, 1)
    measures = {
        "words": held, "word_length": chars / np.maximum(held, 1), "symbol_words": marked / np.maximum(held, 1), "digits": total(_DIGIT) / some,
        "capitals": total(_UPPER) / many, "marks": total(_MARK) / some, "shouts": total(_SHOUT) / some,
        "stutter": stutter / np.maximum(held, 1), "letters": letters / some,
    }
    flags = [(opening >= 0x41) & (opening <= 0x5A) | (opening >= 0x80), _STOP[closing], repeats]
    columns = [np.ones((len(doc), 1), dtype=np.uint8)]
    for name, edges in _BINS.items():
        columns.append((np.digitize(measures[name], edges)[:, None] == np.arange(len(edges) + 1)).astype(np.uint8))
    columns.append(np.stack(flags, axis=1).astype(np.uint8))
    summed = lambda x: np.bincount(doc, weights=x, minlength=n).astype(np.int64)
    counts = {
        "n_words": words.counts().astype(np.int64), "word_chars": summed(chars), "n_symbols": summed(symbols),
        "n_dup_lines": summed(repeats), "n_repeat_words": _repeated_words(words),
    }
    return Lines(doc, number, np.bincount(doc, minlength=n), lines, held, np.concatenate(columns, axis=1), hashes, counts)


def fit_lines(docs: DataFrame, labels: DataFrame, key: str, text: str, drawn: int = DRAWN) -> Chain | None:
    """The model of lines; None if either quality has no labelled document with a line.

    A line is content if a drawn good document holds it, and boilerplate if only bad ones do.
    """
    known = labels.where(F.col(key).isNotNull() & F.col("good").isNotNull()).groupBy(key).agg(F.max("good").alias("good"))
    known = known.join(docs.where(F.col(text).isNotNull()).select(key).distinct(), key, "left_semi")
    sizes = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    if len(sizes) < 2:
        return None
    # A key is drawn if its hash, a number from 0 to 1, lies below the share wanted of its quality.
    place = (F.xxhash64(F.col(key)).cast("double") + 2.0**63) / 2.0**64
    share = F.when(F.col("good"), min(1.0, drawn / sizes[True])).otherwise(min(1.0, drawn / sizes[False]))
    chosen = known.where(place < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_bytes(batch.column("text"), PASS_BYTES):
                lines = read_lines(data, offsets)
                begin = np.cumsum(lines.per_doc) - lines.per_doc
                for i, good in enumerate(batch.column("good").slice(at, len(offsets) - 1).to_pylist()):
                    blocks = -(-int(lines.per_doc[i]) // RUN_LINES)
                    for b in np.unique(np.linspace(0, blocks - 1, min(RUNS, blocks)).astype(int)) if blocks else ():
                        rows = slice(begin[i] + b * RUN_LINES, min(begin[i] + (b + 1) * RUN_LINES, begin[i] + lines.per_doc[i]))
                        yield pa.RecordBatch.from_pylist([{
                            "good": good, "features": np.packbits(lines.features[rows], axis=1).tobytes(), "hashes": lines.hashes[rows].tobytes()}])

    rows = docs.select(key, F.col(text).alias("text")).join(F.broadcast(chosen), key).select("good", "text")
    found = rows.mapInArrow(run, "good boolean, features binary, hashes binary").toArrow().to_pylist()
    if len({r["good"] for r in found}) < 2:
        return None
    lengths = np.array([len(r["hashes"]) // 8 for r in found])
    packed = np.frombuffer(b"".join(r["features"] for r in found), dtype=np.uint8).reshape(int(lengths.sum()), -1)
    x = np.unpackbits(packed, axis=1)[:, :N_FEATURES].astype(float)
    good = np.array([r["good"] for r in found])
    hashes = np.frombuffer(b"".join(r["hashes"] for r in found), dtype=np.uint64)
    states = np.isin(hashes, hashes[np.repeat(good, lengths)]).astype(np.int64)
    weight = np.where(good, 1.0, sizes[False] / sizes[True] * min(1.0, drawn / sizes[True]) / min(1.0, drawn / sizes[False]))
    return fit_chain(x, states, lengths, weight)


QUALITY = T.StructType([
    *[T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
    T.StructField("base_failed", T.BooleanType()), T.StructField("content_words", T.LongType()), T.StructField("kept", T.BooleanType()),
    T.StructField("content", T.ArrayType(T.BooleanType())),
])


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True, drawn: int = DRAWN) -> DataFrame:
    """Every row of ``docs`` with a struct ``quality``; ``with_text=False`` leaves the text out.

    ``labels`` has ``key`` and ``good``; a key with both is good. The struct holds the counts of
    words, their characters, symbols, repeated lines and words in repeated windows; ``base_failed``;
    ``content``, for each line (parted by ``\\n``) whether it is content, null where it has no word;
    ``content_words``; and ``kept``. Without labels of both kinds every line with a word is content.

    A null or empty text has one line without words, fails the base rules and is not kept; its ``content``
    is ``[null]``. Repeated rows and keys get equal results, null keys are judged like others, an empty table
    gives an empty result. An input column named ``quality`` is replaced, all others are kept.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_lines(docs, labels, key, text, drawn))
    base = docs.drop("quality")
    kept = [c for c in base.columns if with_text or c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_bytes(batch.column(text), PASS_BYTES):
                lines = read_lines(data, offsets)
                part = batch.slice(at, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], _verdicts(lines, model.value)], names=[*kept, "quality"])

    schema = T.StructType([*[base.schema[c] for c in kept], T.StructField("quality", QUALITY)])
    return base.mapInArrow(run, schema)


def _verdicts(lines: Lines, model: Chain | None) -> pa.StructArray:
    n = len(lines.per_doc)
    content = model.decode(lines.features, lines.per_doc) if model else np.ones(len(lines.doc), dtype=bool)
    in_content = np.bincount(lines.doc[content], weights=lines.words[content], minlength=n).astype(np.int64)
    c = lines.counts
    failed = (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])
    kept = ~failed & (in_content >= LEAST_CONTENT * c["n_words"])
    begin = np.concatenate([[0], np.cumsum(lines.of_all)])
    flat, blank = np.zeros(begin[-1], dtype=bool), np.ones(begin[-1], dtype=bool)
    at = begin[:-1][lines.doc] + lines.number
    flat[at], blank[at] = content, False
    lists = pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(flat, mask=blank))
    values = [*[pa.array(v, pa.int64()) for v in c.values()], pa.array(failed), pa.array(in_content), pa.array(kept), lists]
    return pa.StructArray.from_arrays(values, names=QUALITY.names)


def content_text(text: str = "text") -> Column:
    """The content lines of a judged text, joined by line breaks."""
    lines = F.arrays_zip(F.split(F.coalesce(text, F.lit("")), "\n", -1).alias("line"), F.col("quality.content").alias("content"))
    return F.array_join(F.transform(F.filter(lines, lambda x: x["content"]), lambda x: x["line"]), "\n")
