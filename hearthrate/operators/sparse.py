"""One-hot encoding of columns with very many categories, as sparse vectors.

The fitted state is a table (column, value, place), which stays in Spark: values are numbered in sorted order by
range partitions, and rows meet their number by a join. Neither categories nor columns are brought to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hearthrate.session import cut_lineage


@dataclass
class SparseEncoder:
    """``table`` numbers the categories of each column from 0; ``sizes`` says how many there are."""

    columns: list[str]
    table: DataFrame
    sizes: dict[str, int]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> SparseEncoder:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
        values = df.select(cells.alias("c")).select("c.*").where(F.col("value").isNotNull()).distinct()
        # Range partitions in order, each numbered on its own; their counts, a few numbers, give where each begins.
        ranged = cut_lineage(values.repartitionByRange("column", "value").withColumn("part", F.spark_partition_id()))
        counts = ranged.groupBy("column", "part").agg(F.count(F.lit(1)).alias("n")).collect()
        sizes: dict[str, int] = dict.fromkeys(columns, 0)
        begins = []
        for row in sorted(counts, key=lambda r: (r["column"], r["part"])):
            begins.append((row["column"], row["part"], sizes[row["column"]]))
            sizes[row["column"]] += row["n"]
        within = F.row_number().over(Window.partitionBy("column", "part").orderBy("value")) - 1
        offsets = df.sparkSession.createDataFrame(begins, "column string, part int, begin long")
        placed = ranged.withColumn("within", within).join(F.broadcast(offsets), ["column", "part"])
        return cls(list(columns), cut_lineage(placed.select("column", "value", (F.col("begin") + F.col("within")).cast("int").alias("place"))), sizes)

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Add a sparse vector: for each column a place for every category but the first; null and unseen values have none.

        A column without categories has no places. Rows and their other columns are kept.
        """
        used = [c for c in self.columns if self.sizes[c] > 1]
        out = df
        for i, c in enumerate(used):
            # The first category takes the last place, which the encoder leaves out; so do null and unseen values.
            last = self.sizes[c] - 1
            side = self.table.where((F.col("column") == c) & (F.col("place") > 0)).select(F.col("value").alias(f"_v{i}"), (F.col("place") - 1.0).alias(f"_p{i}"))
            out = out.join(side, out[c].cast("string") == side[f"_v{i}"], "left").withColumn(f"_p{i}", F.coalesce(f"_p{i}", F.lit(float(last)))).drop(f"_v{i}")
        if not used:
            return out.withColumn(output, array_to_vector(F.array().cast("array<double>")))
        places, hots = [f"_p{i}" for i in range(len(used))], [f"_h{i}" for i in range(len(used))]
        encoder = _encoder(df.sparkSession, places, hots, [self.sizes[c] for c in used])
        return VectorAssembler(inputCols=hots, outputCol=output).transform(encoder.transform(out)).drop(*places, *hots)


def _encoder(spark: SparkSession, places: list[str], hots: list[str], sizes: list[int]) -> OneHotEncoderModel:
    """An encoder for known sizes: it is fitted on the largest places alone."""
    largest = spark.createDataFrame([tuple(float(n - 1) for n in sizes)], ", ".join(f"{p} double" for p in places))
    return OneHotEncoder(inputCols=places, outputCols=hots, dropLast=True).fit(largest)
