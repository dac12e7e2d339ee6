"""Intermediate tables in the shared folder, dropped when the job is done with them."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from hearthrate.session import scratch_path


class Scratch:
    """Tables written once and read again, so that lost executors repeat no earlier stage.

    What a lazy result still reads must stay; it lies below the folder of
    ``spark.checkpoint.dir``, whose owner clears it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self.written = 0

    def store(self, df: DataFrame) -> DataFrame:
        self.written += 1
        path = f"{self.root}/{self.written}"
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        stored._scratch_path = path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        jvm = self.spark._jvm
        for df in stored:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def release_shuffles(self) -> None:
        """Let Spark delete shuffle files that no plan refers to any more.

        It does so when the driver's garbage is collected, which between two
        long stages may be late for the executors' disks.
        """
        gc.collect()
        self.spark._jvm.System.gc()
