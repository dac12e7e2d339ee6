"""Language identification by segmentation-marginalised unigrams.

Each language has a distribution over the pieces of a fixed public vocabulary,
counted as expected uses in its training texts. A text's probability under a
language sums, word by word, over all segmentations into pieces; the prediction
is the language of highest posterior.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hearthrate.llm.batches import append, slices, with_names
from hearthrate.llm.lattice import Memory, Tally, Vocabulary, expected_counts, log_marginals, refined, vocabulary
from hearthrate.llm.words import passes

UNKNOWN = "und"
# Distinct words a task collects before it turns them into piece counts.
TALLY_WORDS = 100_000
# Most languages a model may have; the model, a number for each piece and language, is sent to every task.
MOST_LANGUAGES = 200


@lru_cache(maxsize=2)
def _vocabulary(model: bytes) -> Vocabulary:
    return vocabulary(model)


def remainder(key: str, divisor: int) -> Column:
    """The CRC-32 of the key as text, modulo ``divisor``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % divisor


def train_languages(texts: DataFrame, model: bytes, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Learn from all rows with a text and a language: the languages in order, and log probabilities, piece by language."""
    known = texts.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    langs = [r.lang for r in known.select("lang").distinct().orderBy("lang").limit(MOST_LANGUAGES + 1).collect()]
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    shared = texts.sparkSession.sparkContext.broadcast((model, langs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, names = shared.value
        vocab, code = _vocabulary(content), {name: k for k, name in enumerate(names)}
        counts, tally = np.zeros((vocab.size, len(names))), Tally(len(names))

        def settle() -> None:
            if tally.spelled:
                counts[:] += expected_counts(vocab, vocab.prior, tally.words(), np.arange(len(tally.spelled)), tally.weights)

        for batch in batches:
            codes = np.array([code[v] for v in batch.column("lang").to_pylist()], dtype=np.int64)
            for words in passes(batch.column("text")):
                tally.add(words, np.repeat(codes[words.at:words.at + len(words)], words.counts()))
                if len(tally.spelled) > TALLY_WORDS:
                    settle()
                    tally = Tally(len(names))
        settle()
        piece, lang_ = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang_), pa.array(counts[piece, lang_])], names=["piece", "lang", "uses"])

    used = known.mapInArrow(run, "piece long, lang long, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))
    vocab = _vocabulary(model)
    counts = np.zeros((vocab.size, max(len(langs), 1)))
    # At most one row for each piece of the vocabulary and language.
    rows = used.toPandas()
    counts[rows["piece"], rows["lang"]] = rows["uses"]
    return langs, refined(vocab, counts)


def predict_language(docs: DataFrame, langs: list[str], logp: np.ndarray, model: bytes, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, its posterior among the learned languages.

    A null text, one without a letter, or any text when no language was learned
    is ``und`` with score 0. Ties go to the language that sorts first. Columns of
    these names are replaced; rows and repeats are kept. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, logp))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, table = shared.value
        vocab, memory = _vocabulary(content), Memory(table.shape[1])
        for batch in slices(batches, text):
            total = np.zeros((batch.num_rows, table.shape[1]))
            for words in passes(batch.column(text)):
                rows, back = memory.get(words.hashes, lambda at: log_marginals(vocab, table, words, at))
                doc = words.doc()
                for k in range(table.shape[1]):
                    total[words.at:words.at + len(words), k] = np.bincount(doc, weights=rows[back, k], minlength=len(words))
            best = total.argmax(axis=1)
            share = 1.0 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            spoken = np.array([bool(langs) and v is not None and any(map(str.isalpha, v)) for v in batch.column(text).to_pylist()])
            names = [langs[b] if s else UNKNOWN for b, s in zip(best.tolist(), spoken.tolist())]
            yield append(batch, lang_pred=pa.array(names, pa.string()), score=pa.array(np.where(spoken, share, 0.0)))

    base = docs.drop("lang_pred", "score")
    return base.mapInArrow(run, with_names(base, {"lang_pred": T.StringType(), "score": T.DoubleType()}))


def identify(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held_out: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict every row; adds ``held_out`` too."""
    fold = F.coalesce(remainder(key, folds) == held_out, F.lit(False))
    langs, logp = train_languages(docs.where(~fold), model, text, lang)
    return predict_language(docs, langs, logp, model, text).withColumn("held_out", fold)
