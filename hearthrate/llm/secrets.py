"""Secret scan: fixed patterns, and formats inferred from the credentials these find.

The values that the patterns find label strings by kind. From a bounded sample
of each kind a probabilistic automaton is inferred (``automata``). Then every
string that could be a labelled value, by its symbols and length, is scored
whole by all automata, and kept where a format explains it far better than
chance and than the pairs of characters of all texts do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hearthrate.llm.automata import SYMBOLS, Automaton
from hearthrate.llm.batches import append, slices, with_names
from hearthrate.session import scratch_path

# (kind, pattern of the whole match, group that holds the value, least length of that group)
PATTERNS = (
    ("assign", re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 1, 8),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile("[0-9a-f]{32,}"), 0, 32),
)
INFERRED = "format"
# Labelled strings per kind an automaton is inferred from: those of smallest hash.
SAMPLE = 400
# Least mean log ratio per symbol; a uniform hexadecimal string has log(66/16) = 1.4.
LEAST_FIT = 0.8
# Least log ratio of a whole string: that of 16 symbols of the least fit. Shorter strings need a better fit.
LEAST_EVIDENCE = 16 * LEAST_FIT
# A labelled value takes part in the fit of its automaton up to this length; longer ones are scored, not learned from.
LONGEST_LEARNED = 4096
# Scores of short strings remembered in a task.
REMEMBERED, REMEMBERED_LENGTH = 50_000, 40
# Kind of the rows that count pairs of characters.
PAIR = "pair"
ASCII = 128

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()),
]))
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of each kept match, by kind, then start."""
    return [
        (kind, m.start(), m.end(), m[group])
        for kind, pattern, group, least in PATTERNS for m in pattern.finditer(text) if len(m[group]) >= least
    ]


@dataclass
class Candidates:
    """Which strings are scored (the symbols and the least length of a labelled value), and how likely ordinary text is to hold them.

    ``pairs[a][b]`` is the log probability of ``b`` after ``a`` by character
    code, 0 standing for every character before a string; without it the
    comparison is with random symbols alone.
    """

    symbols: str = "+-./0123456789=ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz"
    least: int = 8
    pairs: list[list[float]] | None = None
    pattern: re.Pattern = field(init=False)

    def __post_init__(self) -> None:
        self.pattern = re.compile(f"[{re.escape(self.symbols)}]{{{self.least},}}")

    def strings(self, text: str) -> Iterator[tuple[int, int]]:
        """Longest runs of symbols, without full stops at their ends."""
        for m in self.pattern.finditer(text):
            start, end = m.start() + len(m[0]) - len(m[0].lstrip(".")), m.start() + len(m[0].rstrip("."))
            if end - start >= self.least:
                yield start, end

    def ordinary(self, string: str) -> float:
        """Mean log ratio per symbol of ordinary text's likelihood to random symbols, zero at least."""
        if self.pairs is None:
            return 0.0
        codes = string.encode()
        return max(0.0, sum(self.pairs[a][b] for a, b in zip(b"\0" + codes, codes)) / len(string) + math.log(SYMBOLS))


@dataclass
class Formats:
    """Automata by kind and the candidates they are asked about."""

    automata: dict[str, Automaton]
    candidates: Candidates = field(default_factory=Candidates)
    known: dict[str, float] = field(default_factory=dict)

    def score(self, string: str) -> float:
        """Best fit of any format above that of ordinary text."""
        if string in self.known:
            return self.known[string]
        found = max(f.fit(string) for f in self.automata.values()) - self.candidates.ordinary(string)
        if len(string) <= REMEMBERED_LENGTH:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[string] = found
        return found


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, value, n): every pattern match in every text; of kind ``pair`` the counts of two ASCII characters in a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kinds: list[str], values: list[str], n: list[int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string()), pa.array(n, pa.int64())], names=["kind", "value", "n"])

        pairs = np.zeros(ASCII * ASCII, dtype=np.int64)
        for batch in slices(batches, text):
            texts = [value or "" for value in batch.column(text).to_pylist()]
            found = [(s[0], s[3]) for value in texts for s in base_spans(value)]
            yield rows([k for k, _ in found], [v for _, v in found], [1] * len(found))
            codes = np.frombuffer(("\n" + "\n".join(texts)).encode(), dtype=np.uint8).astype(np.int32)
            codes[codes >= ASCII] = 0
            pairs += np.bincount(codes[:-1] * ASCII + codes[1:], minlength=ASCII * ASCII)
        held = np.flatnonzero(pairs).tolist()
        yield rows([PAIR] * len(held), [chr(p // ASCII) + chr(p % ASCII) for p in held], pairs[held].tolist())

    return docs.select(text).mapInArrow(run, "kind string, value string, n long")


def infer_formats(examples: DataFrame, sample: int = SAMPLE) -> Formats:
    """One automaton for each kind of ``examples`` (as ``labelled`` gives them), and how ordinary text continues.

    At most ``sample`` distinct values per kind, of at most ``LONGEST_LEARNED``
    symbols, make an automaton: those of smallest hash, so the choice does not
    depend on order or partitions. Pairs of characters come from all rows.
    """
    path = scratch_path(examples.sparkSession, "labelled")
    examples.write.parquet(path)
    stored = examples.sparkSession.read.parquet(path)
    values = stored.where(F.col("kind") != PAIR)
    automata = {}
    for kind, _, _, _ in PATTERNS:
        own = values.where((F.col("kind") == kind) & (F.length("value") <= LONGEST_LEARNED)).select("value").distinct()
        learned = [r.value for r in own.orderBy(F.xxhash64("value"), "value").limit(sample).collect()]
        if learned:
            automata[kind] = Automaton(learned)
    if not automata:
        return Formats({})
    # At most as many rows as ASCII has pairs.
    counts = np.zeros((ASCII, ASCII))
    for row in stored.where(F.col("kind") == PAIR).groupBy("value").agg(F.sum("n").alias("n")).collect():
        counts[ord(row.value[0]), ord(row.value[1])] = row.n
    return Formats(automata, Candidates(pairs=_log_shares(counts, Candidates.symbols)))


def _log_shares(counts: np.ndarray, symbols: str) -> list[list[float]]:
    """Log share of each symbol among the symbols after a character; all others count as one, a string's start."""
    own = np.zeros(ASCII, dtype=bool)
    own[[ord(c) for c in symbols]] = True
    follow = np.where(own[:, None], counts, 0.0)
    follow[0] = counts[~own].sum(axis=0)
    follow[:, ~own] = 0.0
    weight = np.where(own, follow + 0.5, 1.0)
    return np.log(weight / np.where(own, weight, 0.0).sum(axis=1, keepdims=True)).tolist()


def all_spans(text: str, formats: Formats | dict[str, Automaton]) -> list[tuple[str, int, int, float]]:
    """Pattern matches and inferred ones by start, then kind as listed; inferred ones overlap no other."""
    formats = formats if isinstance(formats, Formats) else Formats(formats)
    base, automata = base_spans(text), formats.automata
    order = {kind: i for i, (kind, _, _, _) in enumerate(PATTERNS)}
    spans = [(start, order[kind], kind, end, automata[kind].fit(value) if kind in automata else 0.0) for kind, start, end, value in base]
    taken = sorted((start, end) for _, start, end, _ in base)
    at, reach = 0, -1
    for start, end in formats.candidates.strings(text) if automata else ():
        while at < len(taken) and taken[at][0] < end:
            reach, at = max(reach, taken[at][1]), at + 1
        if reach > start:
            continue
        best = formats.score(text[start:end])
        if best >= LEAST_FIT and best * (end - start) >= LEAST_EVIDENCE:
            spans.append((start, len(order), INFERRED, end, best))
    return [(kind, start, end, score) for start, _, kind, end, score in sorted(spans)]


def find_secrets(docs: DataFrame, text: str = "text", formats: Formats | dict[str, Automaton] | None = None) -> DataFrame:
    """Add ``secrets``: array of (kind, start, end, score), in code points, by start, then kind as listed.

    Pattern kinds keep every match of the least length; ``score`` is its fit to
    the kind's inferred format. Kind ``format`` holds strings found by an
    inferred format alone. ``formats`` default to those inferred from ``docs``
    itself; a table without any labelled string has none. Null and empty texts
    have an empty array. A column called ``secrets`` is replaced; rows, columns
    and repeats are kept. Two passes, no shuffle of texts.
    """
    learned = infer_formats(labelled(docs, text)) if formats is None else formats
    shared = docs.sparkSession.sparkContext.broadcast(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = [
                [{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in all_spans(value or "", shared.value)]
                for value in batch.column(text).to_pylist()
            ]
            yield append(batch, secrets=pa.array(found, _SPANS))

    base = docs.drop("secrets")
    return base.mapInArrow(run, with_names(base, {"secrets": SPANS}))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every secret by ``mark``; overlapping spans are replaced together. Other columns stay."""
    found = find_secrets(docs, text)

    def step(state: Column, s: Column) -> Column:
        start, end = F.greatest(s["start"], state["at"]), F.greatest(s["end"], state["at"])
        joined = (s["start"] < state["at"]) & (state["at"] > 0)
        kept = F.concat(state["out"], F.substring(F.col(text), state["at"] + 1, start - state["at"]), F.when(joined, "").otherwise(mark))
        return F.struct(end.alias("at"), kept.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    cleaned = F.aggregate("secrets", begin, step, lambda s: F.concat(s["out"], F.substring(F.col(text), s["at"] + 1, F.length(text))))
    return found.withColumn(text, F.when(F.size("secrets") > 0, cleaned).otherwise(F.col(text))).drop("secrets").select(docs.columns)
