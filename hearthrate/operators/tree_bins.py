"""Rows binned at the thresholds of a fitted tree ensemble.

Rows that lie between the same thresholds in every feature take the same path
through every tree. MLlib cuts a continuous feature at ``maxBins - 1`` places at
most, so the distinct bins are bounded by the model and not by the table: what
is heavy per row is done once for each of them and joined back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hearthrate.session import scratch_path

# Combinations of bins up to which the table of their results is sent to every task; a larger one is joined by a shuffle.
BROADCAST_BINS = 250_000


def saved_nodes(model: Model, spark: SparkSession) -> DataFrame:
    """(treeID, nodeData) of a fitted MLlib tree ensemble, read from its saved form."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    return spark.read.parquet(f"{path}/data")


def thresholds(model: Model, spark: SparkSession) -> list[list[float]] | None:
    """For each feature the thresholds of the model, in order; none if it splits by categories or at the end of the numbers."""
    split = F.col("nodeData.split")
    cuts = saved_nodes(model, spark).where(F.col("nodeData.leftChild") >= 0).select(
        split["featureIndex"].alias("feature"), split["numCategories"].alias("categories"),
        split["leftCategoriesOrThreshold"][0].alias("cut"),
    ).distinct()
    edges: list[set[float]] = [set() for _ in range(model.numFeatures)]
    for row in cuts.collect():
        if row["categories"] >= 0 or not math.isfinite(_above(row["cut"])) and not math.isnan(row["cut"]):
            return None
        # Nothing lies at or below NaN, so it separates nothing.
        if not math.isnan(row["cut"]):
            edges[row["feature"]].add(row["cut"])
    return [sorted(e) for e in edges]


def _above(cut: float) -> float:
    return math.nextafter(cut, math.inf)


def add_bins(df: DataFrame, values: Sequence[Column], edges: Sequence[Sequence[float]], names: Sequence[str]) -> DataFrame:
    """Add for each value the number of thresholds below it; a missing value lies above all, as in the trees."""
    cut = [(v, e, n) for v, e, n in zip(values, edges, names) if e]
    # A value on a threshold belongs below it, and a bucket holds its lower end, so buckets start one number later.
    buckets = Bucketizer(
        splitsArray=[[-math.inf, *map(_above, e), math.inf] for _, e, _ in cut],
        inputCols=[f"{n}_value" for _, _, n in cut], outputCols=[f"{n}_bucket" for _, _, n in cut],
    )
    known = df.withColumns({f"{n}_value": F.coalesce(F.nanvl(v, F.lit(math.inf)), F.lit(math.inf)) for v, _, n in cut})
    placed = buckets.transform(known) if cut else known
    bins = {n: F.col(f"{n}_bucket").cast("int") if e else F.lit(0) for e, n in zip(edges, names)}
    return placed.withColumns(bins).drop(*[f"{n}_{part}" for _, _, n in cut for part in ("value", "bucket")])


def bin_values(names: Sequence[str], edges: Sequence[Sequence[float]]) -> list[Column]:
    """A value of each bin: its upper threshold, or infinity in the last."""
    return [F.element_at(F.array(*map(F.lit, [*e, math.inf])), F.col(n) + 1) for n, e in zip(names, edges)]


def join_bins(binned: DataFrame, results: DataFrame, names: Sequence[str], edges: Sequence[Sequence[float]]) -> DataFrame:
    """Every row with the result of its bins. A few bins hold many rows each, so a small table of them is sent to the rows."""
    small = math.prod(len(e) + 1 for e in edges) <= BROADCAST_BINS
    return binned.join(F.broadcast(results) if small else results, list(names))


def predict_by_bins(model: Model, df: DataFrame) -> DataFrame:
    """``model.transform(df)`` of a tree ensemble, with every distinct combination of bins sent through the trees once."""
    edges = thresholds(model, df.sparkSession)
    if edges is None:
        return model.transform(df)
    names = [f"_bin{i}" for i in range(len(edges))]
    vector, out = model.getFeaturesCol(), model.getPredictionCol()
    numbers = df.withColumn("_numbers", vector_to_array(vector))
    binned = add_bins(numbers, [F.col("_numbers")[i] for i in range(len(edges))], edges, names)
    distinct = binned.select(names).distinct().withColumn(vector, array_to_vector(F.array(*bin_values(names, edges))))
    predicted = model.transform(distinct).select(*names, out)
    return join_bins(binned, predicted, names, edges).drop(*names, "_numbers")
