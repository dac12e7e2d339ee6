"""A training-corpus pipeline: language, near-duplicates, secrets, mixing, pieces.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept;
``run`` writes each result as Parquet and gives the next stage what it reads back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hearthrate.llm.language import UNKNOWN, identify
from hearthrate.llm.mixing import mix_sources, take_by_rate
from hearthrate.llm.near_dedup import near_duplicates
from hearthrate.llm.pieces import encode_pieces, model_bytes
from hearthrate.llm.queries import PIECE_MODEL, domains
from hearthrate.llm.scratch import Scratch
from hearthrate.llm.secrets import redact

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A prediction below this posterior is no language of the training texts.
LEAST_POSTERIOR = 0.5
# The toxic domain is mixed in with this multiple of its natural tokens, the others with theirs.
FACTORS = {"toxic": 0.25}


def _model() -> bytes:
    return model_bytes(public_tokenizers.path(PIECE_MODEL))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go; the others carry the predicted one."""
    found = identify(docs, _model())
    kept = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_POSTERIOR))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest id.

    Rows without id are alone and all stay. Of rows that repeat a kept document's id
    and text one stays, the first by its other columns.
    """
    kept = near_duplicates(docs).where("kept").select("doc_id").distinct()
    # The join deals rows by id already, so this window sorts but moves no text; texts are told apart by 256-bit hashes.
    same = Window.partitionBy("doc_id", F.sha2("text", 256)).orderBy("lang", "source", "n_chars")
    known = docs.join(kept, "doc_id", "left_semi").withColumn("place", F.row_number().over(same)).where("place = 1")
    return known.select(*COLUMNS).unionByName(docs.where("doc_id is null").select(*COLUMNS))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose rate rounds to none go."""
    rated, _ = mix_sources(docs, domains(spark, sf_dir), factors=FACTORS)
    return take_by_rate(rated).select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining text as ids, with the spans of its pieces and whether decoding gives the text back."""
    coded = encode_pieces(docs, _model())
    return coded.select(
        "doc_id", "lang", "source", "n_chars", "ids", "piece_starts", "piece_ends",
        F.size("ids").cast("long").alias("n_tokens"), (F.col("decoded") == F.col("text")).alias("round_trip"),
    )


STAGES = [("language", language), ("near_dedup", near_dedup), ("secrets", secrets), ("mixing", mixing), ("pieces", pieces)]
# Models and inferred formats decide here, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs
