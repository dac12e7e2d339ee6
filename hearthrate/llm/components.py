"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hearthrate.llm.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every end of ``edges`` (a, b); the component is its smallest node.

    In each round every node moves to the neighbour, or itself, of smallest
    hash; edges are carried to the new places and loops dropped. A star is done
    in two rounds, and a chain loses about half of its places in each.
    Minima are aggregated before the shuffle, so a node with very many neighbours is no hot spot.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    placed = scratch.store(nodes.select("node", F.col("node").alias("place")))
    left = scratch.store(edges.where("a <> b").distinct())

    def drawn(node: str) -> Column:
        return F.struct(F.xxhash64(node).alias("draw"), F.col(node).alias("to"))

    while not left.isEmpty():
        both = left.select("a", drawn("b").alias("best")).union(left.select("b", drawn("a")))
        moves = both.groupBy("a").agg(F.min("best").alias("best")).select(F.col("a").alias("from"), F.least("best", drawn("a"))["to"].alias("to"))
        moves = scratch.store(moves)
        to_a = moves.select(F.col("from").alias("a"), F.col("to").alias("ta"))
        to_b = moves.select(F.col("from").alias("b"), F.col("to").alias("tb"))
        carried = left.join(to_a, "a").join(to_b, "b").where("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        old_left, old_placed, left = left, placed, scratch.store(carried)
        moved = placed.join(moves.withColumnRenamed("from", "place"), "place", "left")
        placed = scratch.store(moved.select("node", F.coalesce("to", "place").alias("place")))
        scratch.drop(old_left, old_placed, moves)
    smallest = placed.groupBy("place").agg(F.min("node").alias("component"))
    out = scratch.store(placed.join(smallest, "place").select("node", "component"))
    scratch.drop(left, placed)
    return out
