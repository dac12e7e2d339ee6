"""Per-row feature attributions of linear and tree models, and their summaries.

Attributions travel as one array per row (``phi``, in feature order) beside the
base value; per-row rankings are array operations and need no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.functions.nulls import ratio
from hearthrate.functions.pricing import CAPPED_CLIP, price_from_log
from hearthrate.operators.tree_bins import add_bins, join_bins, saved_nodes

# Seeds compared for stability and the rank spread called stable.
STABILITY_SEEDS = (42, 7, 123, 2024, 999)
STABLE_RANK_STD = 3.0
UNION_SIZE = 15
TOP_PER_SEED = 10
# Nodes of a tree model whose leaves are sent to every task, some hundred bytes each.
MOST_NODES = 500_000


def linear_attribution(
    df: DataFrame, key: str, features: Sequence[str], coefficients: Sequence[float], intercept: float
) -> DataFrame:
    """(key, base, phi): coefficient times distance from the feature's mean over the table."""
    means = df.agg(*[F.avg(c).alias(c) for c in features]).first()
    base = intercept + sum(w * means[c] for c, w in zip(features, coefficients))
    phi = F.array(*[F.lit(float(w)) * (F.col(c) - F.lit(means[c])) for c, w in zip(features, coefficients)])
    return df.select(key, F.lit(float(base)).alias("base"), phi.alias("phi"))


@dataclass(frozen=True)
class LeafPath:
    """One leaf: its value and, per feature on its path, the admitted interval and cover share."""

    value: float
    cover_share: float
    features: tuple[int, ...]
    above: tuple[float, ...]
    up_to: tuple[float, ...]
    shares: tuple[float, ...]


def leaf_paths(nodes: Mapping[int, Mapping], weight: float) -> list[LeafPath]:
    """Leaves of one tree from its stored nodes (id, children, split, training rows)."""
    paths: list[LeafPath] = []
    whole = nodes[0]["rows"]

    def walk(node_id: int, limits: dict[int, tuple[float, float, float]]) -> None:
        node = nodes[node_id]
        if node["left"] < 0:
            order = sorted(limits)
            paths.append(LeafPath(
                weight * node["prediction"], node["rows"] / whole, tuple(order),
                tuple(limits[f][0] for f in order), tuple(limits[f][1] for f in order),
                tuple(limits[f][2] for f in order),
            ))
            return
        feature, cut = node["feature"], node["threshold"]
        low, high, share = limits.get(feature, (-math.inf, math.inf, 1.0))
        for child, bounds in ((node["left"], (low, min(high, cut))), (node["right"], (max(low, cut), high))):
            part = share * nodes[child]["rows"] / node["rows"]
            walk(child, {**limits, feature: (*bounds, part)})

    walk(0, {})
    return paths


def ensemble_leaves(model, spark) -> list[LeafPath]:
    """Leaf paths of a fitted MLlib tree ensemble, read from its saved form.

    The model's nodes come to the driver and its leaves go to every task; a model of more than ``MOST_NODES`` is refused.
    """
    if model.totalNumNodes > MOST_NODES:
        raise ValueError(f"attributions of {model.totalNumNodes} nodes; at most {MOST_NODES} can be sent to the tasks")
    trees: dict[int, dict[int, dict]] = {}
    for row in saved_nodes(model, spark).collect():
        node = row["nodeData"]
        split = node["split"]
        trees.setdefault(row["treeID"], {})[node["id"]] = {
            "prediction": node["prediction"],
            "rows": float(node["rawCount"]),
            "left": node["leftChild"],
            "right": node["rightChild"],
            "feature": split["featureIndex"],
            "threshold": split["leftCategoriesOrThreshold"][0] if split["leftCategoriesOrThreshold"] else math.nan,
        }
    weights = model.treeWeights if "GBT" in type(model).__name__ else [1 / len(trees)] * len(trees)
    return [leaf for tree_id in sorted(trees) for leaf in leaf_paths(trees[tree_id], weights[tree_id])]


def _path_shares(inside: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shapley share of each path feature, for 0/1 rows ``inside`` and cover shares.

    For feature i the product over the other features of (share + inside * t)
    is expanded in t; its coefficients carry the Shapley subset weights.
    """
    rows, d = inside.shape
    weights = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
    out = np.empty((rows, d))
    for i in range(d):
        poly = np.zeros((rows, d))
        poly[:, 0] = 1.0
        for j in range(d):
            if j != i:
                raised = np.roll(poly, 1, axis=1)
                raised[:, 0] = 0.0
                poly = poly * shares[j] + raised * inside[:, j : j + 1]
        out[:, i] = (inside[:, i] - shares[i]) * (poly @ np.array(weights))
    return out


def attribute_batch(x: np.ndarray, leaves: Sequence[LeafPath]) -> np.ndarray:
    """Path-dependent Shapley values of a batch of rows; rows that agree on a path share its work."""
    phi = np.zeros_like(x, dtype=float)
    for leaf in leaves:
        d = len(leaf.features)
        if d == 0:
            continue
        part = x[:, leaf.features]
        inside = (part > np.array(leaf.above)) & (part <= np.array(leaf.up_to))
        codes = inside @ (1 << np.arange(d))
        _, first, back = np.unique(codes, return_index=True, return_inverse=True)
        shares = _path_shares(inside[first].astype(float), np.array(leaf.shares))
        phi[:, leaf.features] += leaf.value * shares[back]
    return phi


def bin_edges(leaves: Sequence[LeafPath], features: int) -> list[list[float]]:
    """For each feature the thresholds of the model, in order."""
    edges: list[set[float]] = [set() for _ in range(features)]
    for leaf in leaves:
        for f, low, high in zip(leaf.features, leaf.above, leaf.up_to):
            edges[f] |= {v for v in (low, high) if math.isfinite(v)}
    return [sorted(e) for e in edges]


def tree_attribution(df: DataFrame, key: str, features: Sequence[str], model) -> DataFrame:
    """(key, base, phi): path-dependent tree attributions.

    Rows that lie between the same thresholds in every feature have the same attributions. So rows are binned at the
    model's thresholds, the distinct bins attributed once, and the result joined back.
    """
    spark = df.sparkSession
    leaves = ensemble_leaves(model, spark)
    base = float(sum(leaf.value * leaf.cover_share for leaf in leaves))
    edges = bin_edges(leaves, len(features))
    shared = spark.sparkContext.broadcast((leaves, edges))
    bins = [f"_bin{i}" for i in range(len(features))]
    binned = add_bins(df, [F.col(c).cast("double") for c in features], edges, bins).select(key, *bins)

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        paths, cuts = shared.value
        for batch in batches:
            # Any value of the bin will do: its upper threshold, or infinity in the last.
            x = np.column_stack([np.array([*e, math.inf])[batch[b].to_numpy()] for b, e in zip(bins, cuts)])
            out = batch[bins].copy()
            out["phi"] = list(attribute_batch(x, paths))
            yield out

    signatures = binned.select(bins).distinct()
    phi = signatures.mapInPandas(attribute, ", ".join(f"{b} int" for b in bins) + ", phi array<double>")
    return join_bins(binned, phi, bins, edges).select(key, F.lit(base).alias("base"), "phi")


def attribution_long(attributed: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(key, feature, attribution): the matrix in long form."""
    names = F.array(*[F.lit(c) for c in features])
    zipped = F.explode(F.arrays_zip(names.alias("feature"), F.col("phi").alias("attribution")))
    return attributed.select(key, zipped.alias("z")).select(key, "z.feature", "z.attribution")


def attribution_summary(attributed: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean |attribution|, share of the total, direction, approximate price impact and rank per feature."""
    wide = attributed.select(*[F.col("phi")[i].alias(f"p{i}") for i in range(len(features))])
    sums = wide.agg(
        *[F.avg(F.abs(f"p{i}")).alias(f"a{i}") for i in range(len(features))],
        *[F.avg(f"p{i}").alias(f"m{i}") for i in range(len(features))],
    )
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"a{i}").alias("mean_abs"), F.col(f"m{i}").alias("mean"))
        for i, c in enumerate(features)
    ]
    table = sums.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    # One row per feature: a window over the whole table is a window over the column list.
    every = Window.partitionBy(F.lit(1))
    return table.select(
        "feature",
        "mean_abs",
        (ratio(F.col("mean_abs"), F.sum("mean_abs").over(every)) * 100).alias("share_pct"),
        F.when(F.col("mean") > 0, "up").otherwise("down").alias("direction"),
        ((F.exp("mean_abs") - 1) * 100).alias("impact_pct"),
        F.row_number().over(every.orderBy(F.desc("mean_abs"), "feature")).alias("rank"),
    )


def group_callout(summary: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """(group, feature, rank, mean_abs, share_pct) for the features of each named group."""
    rows = [(group, feature) for group, members in groups.items() for feature in members]
    members = summary.sparkSession.createDataFrame(rows, "group string, feature string")
    return members.join(summary, "feature").select("group", "feature", "rank", "mean_abs", "share_pct")


def row_contributions(attributed: DataFrame, key: str, features: Sequence[str], top: int = 15) -> DataFrame:
    """(key, rank, feature, attribution): each row's strongest contributions, sorted inside the row."""
    pairs = [
        F.struct(
            (-F.abs(F.col("phi")[i])).alias("order"), F.lit(c).alias("feature"), F.col("phi")[i].alias("attribution")
        )
        for i, c in enumerate(features)
    ]
    best = F.slice(F.array_sort(F.array(*pairs)), 1, top)
    return attributed.select(key, F.posexplode(best).alias("at", "p")).select(
        key, (F.col("at") + 1).alias("rank"), "p.feature", "p.attribution"
    )


def driver_sentence(attributed: DataFrame, key: str, features: Sequence[str], top: int = 3) -> DataFrame:
    """(key, drivers): the strongest features of a row in words."""
    pairs = [
        F.struct((-F.abs(F.col("phi")[i])).alias("order"), F.concat(
            F.lit(f"{c} ("), F.when(F.col("phi")[i] > 0, "increases").otherwise("decreases"), F.lit(" price)")
        ).alias("text"))
        for i, c in enumerate(features)
    ]
    best = F.slice(F.array_sort(F.array(*pairs)), 1, top)
    return attributed.select(key, F.array_join(F.transform(best, lambda p: p["text"]), ", ").alias("drivers"))


def base_price(base: Column, clip: tuple[float, float] = CAPPED_CLIP) -> Column:
    """The base value of the attributions in dollars."""
    return price_from_log(base, clip)


def importance_stability(importances: DataFrame, seeds: Sequence[int] = STABILITY_SEEDS) -> DataFrame:
    """Rank of each feature per seed, its mean and sample std, and whether it is stable.

    ``importances`` holds (seed, feature, mean_abs). Kept are the first 15 of the
    features any seed puts in its top 10, in order of appearance. Ranks average
    over ties and are cut to whole numbers.
    """
    per_seed = Window.partitionBy("seed")
    tied = Window.partitionBy("seed", "mean_abs")
    falling = per_seed.orderBy(F.desc("mean_abs"))
    place = {seed: i for i, seed in enumerate(seeds)}
    order = F.coalesce(*[F.when(F.col("seed") == seed, i) for seed, i in place.items()])
    ranked = importances.withColumns({
        "rank": (F.rank().over(falling) + (F.count(F.lit(1)).over(tied) - 1) / 2).cast("int"),
        "_place": F.row_number().over(per_seed.orderBy(F.desc("mean_abs"), "feature")),
        "_order": order,
    })
    in_top = F.when(F.col("_place") <= TOP_PER_SEED, F.struct("_order", "_place"))
    wide = ranked.groupBy("feature").agg(
        F.min(in_top).alias("_first"),
        *[F.max(F.when(F.col("seed") == seed, F.col("rank"))).alias(f"seed_{seed}") for seed in seeds],
        F.avg("rank").alias("mean_rank"),
        F.stddev_samp("rank").alias("rank_std"),
    )
    union = wide.where(F.col("_first").isNotNull()).orderBy("_first").limit(UNION_SIZE).drop("_first")
    return union.withColumn("stable", (F.col("rank_std") < STABLE_RANK_STD).cast("int")).orderBy("mean_rank", "feature")
