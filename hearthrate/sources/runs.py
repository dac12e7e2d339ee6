"""Experiment runs as a long table (run_id, kind, key, value), and their summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from hearthrate.session import RESULT_ROWS

KINDS = ("params", "metrics", "tags")
RUN_SCHEMA = "run_id string, kind string, key string, value string"


def run_rows(
    spark: SparkSession,
    run_id: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None,
) -> DataFrame:
    rows = [
        (run_id, kind, key, repr(value) if isinstance(value, float) else str(value))
        for kind, entries in zip(KINDS, (params, metrics, tags or {}))
        for key, value in entries.items()
    ]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_runs(runs: DataFrame, path: str) -> None:
    """Add runs to the log."""
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def write_run_files(runs: DataFrame, path: str, at_ms: int, most: int = RESULT_ROWS) -> None:
    """One small file per entry, ``<run>/<kind>/<key>``, a metric's with time, value and step.

    The driver writes the files, as tracking tools do; the entries of more than ``most`` are refused.
    """
    rows = runs.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} run entries")
    spark = runs.sparkSession
    jvm = spark._jvm
    for row in rows:
        text = f"{at_ms} {row['value']} 0\n" if row["kind"] == "metrics" else str(row["value"])
        file = jvm.org.apache.hadoop.fs.Path(f"{path}/{row['run_id']}/{row['kind']}/{row['key']}")
        stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()


def scan_run_files(spark: SparkSession, path: str) -> DataFrame:
    """Runs kept as one small file per entry: ``<run>/<kind>/<key>``.

    A metric file holds time, value and step; the others hold the bare value.
    """
    files = (
        spark.read.option("recursiveFileLookup", True)
        .text(path, wholetext=True)
        .select("value", F.col("_metadata.file_path").alias("file"))
    )
    parts = r"/([^/]+)/(params|metrics|tags)/([^/]+)$"
    named = files.where(F.col("file").rlike(parts)).select(
        F.regexp_extract("file", parts, 1).alias("run_id"),
        F.regexp_extract("file", parts, 2).alias("kind"),
        F.regexp_extract("file", parts, 3).alias("key"),
        F.trim("value").alias("text"),
    )
    value = F.when(F.col("kind") == "metrics", F.split("text", r"\s+")[1]).otherwise(F.col("text"))
    return named.select("run_id", "kind", "key", value.alias("value"))


def runs_table(runs: DataFrame, metrics: Sequence[str], params: Sequence[str] = (), tags: Sequence[str] = ()) -> DataFrame:
    """One row per run with the named entries as columns."""
    def entry(kind: str, key: str):
        return F.max(F.when((F.col("kind") == kind) & (F.col("key") == key), F.col("value")))

    return runs.groupBy("run_id").agg(
        *[entry("metrics", m).try_cast("double").alias(m) for m in metrics],
        *[entry("params", p).alias(p) for p in params],
        *[entry("tags", t).alias(t) for t in tags],
    )


def run_summary(runs: DataFrame, metrics: Sequence[str], order_by: str = "test_mae") -> DataFrame:
    """Runs by the chosen metric, best first, with the production mark."""
    table = runs_table(runs, metrics, ["model_name"], ["production"])
    return table.withColumn("production", F.coalesce((F.col("production") == "true").cast("int"), F.lit(0))).orderBy(
        F.asc_nulls_last(order_by), "run_id"
    )
