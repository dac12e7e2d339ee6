"""Approximate nearest neighbours over learned partitions.

From a bounded sample a neighbour graph is built and cut into balanced parts by
recursive bisection; a small classifier learns to tell a vector's part. Every
vector is indexed under its most probable part. A query visits parts in order
of probability until these add up to ``mass``, and what it meets is reranked
by exact cosine in double precision. Parts are split into blocks of bounded
size, so a part that holds many of the vectors is searched by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthrate.llm.scratch import Scratch

# Vectors the graph and the classifier are fitted on: those of smallest hash.
SAMPLE = 4096
NEIGHBOURS = 12
# Vectors a part should hold, and the most parts a sample can be cut into.
PART_ROWS = 1500
MOST_PARTS = 128
HIDDEN = 64
MASS = 0.992
# A query visits parts until they hold so many vectors at least.
LEAST_SEEN = 200
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024
_FOUND = "query_id long, vec_id long, score double"


def units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows of doubles."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), dtype=np.int64)
    for i in range(0, len(x), 512):
        near = x[i:i + 512] @ x.T
        near[np.arange(len(near)), np.arange(i, i + len(near))] = -np.inf
        out[i:i + 512] = np.argpartition(-near, k - 1, axis=1)[:, :k]
    return out


def bisect(x: np.ndarray, graph: np.ndarray, nodes: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Halves of equal size: a first cut along the widest direction, then swaps that cut fewer graph edges."""
    centred = x[nodes] - x[nodes].mean(axis=0)
    direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
    side = np.zeros(len(nodes), dtype=np.int64)
    side[np.argsort(centred @ direction, kind="stable")[len(nodes) // 2:]] = 1
    place = np.full(len(x), -1)
    place[nodes] = np.arange(len(nodes))
    source = np.repeat(np.arange(len(nodes)), graph.shape[1])
    target = place[graph[nodes].ravel()]
    source, target = source[target >= 0], target[target >= 0]
    a, b = np.concatenate([source, target]), np.concatenate([target, source])
    for _ in range(rounds):
        across = np.bincount(a, weights=np.where(side[a] != side[b], 1.0, -1.0), minlength=len(nodes))
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        left, right = left[np.argsort(-across[left], kind="stable")], right[np.argsort(-across[right], kind="stable")]
        pairs = min(len(left), len(right))
        good = np.flatnonzero(across[left[:pairs]] + across[right[:pairs]] > 0)
        # Only part of the gainful swaps at once: neighbours that move together undo each other's gain.
        good = good[:max(1, len(good) // 4)] if len(good) else good
        if not len(good):
            break
        side[left[good]], side[right[good]] = 1, 0
    return side


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """A part from 0 for each vector; ``parts`` is a power of two."""
    label = np.zeros(len(x), dtype=np.int64)
    count = 1
    while count < parts:
        for part in range(count):
            nodes = np.flatnonzero(label == part)
            if len(nodes) > 1:
                label[nodes] = part + count * bisect(x, graph, nodes)
        count *= 2
    return label


@dataclass
class Router:
    """A classifier with one hidden layer over unit vectors."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def chances(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def train_router(x: np.ndarray, goal: np.ndarray, steps: int = 200, rate: float = 0.02) -> Router:
    """Adam on the cross entropy to the shares of parts in ``goal``, full batches, fixed seed."""
    draw = np.random.default_rng(0)
    x, goal = x.astype(np.float32), goal.astype(np.float32)
    dim, parts = x.shape[1], goal.shape[1]
    p = [draw.normal(0, (2 / dim) ** 0.5, (dim, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, (2 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
    p = [v.astype(np.float32) for v in p]
    first, second = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    for t in range(1, steps + 1):
        h = np.maximum(x @ p[0] + p[1], 0)
        z = h @ p[2] + p[3]
        e = np.exp(z - z.max(axis=1, keepdims=True))
        d = (e / e.sum(axis=1, keepdims=True) - goal) / len(x)
        dh = (d @ p[2].T) * (h > 0)
        grads = [x.T @ dh + 1e-5 * p[0], dh.sum(axis=0), h.T @ d + 1e-5 * p[2], d.sum(axis=0)]
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            p[i] = p[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*(v.astype(np.float64) for v in p))


def fit_router(sample: np.ndarray, rows: int) -> Router:
    """Cut the sample's neighbour graph into parts for ``rows`` vectors and learn the route to them."""
    x = np.unique(units(sample), axis=0)
    parts = 1
    while parts < MOST_PARTS and parts * PART_ROWS < rows and parts * 16 <= len(x):
        parts *= 2
    if parts == 1:
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    graph = neighbour_graph(x, NEIGHBOURS)
    label = balanced_parts(x, graph, parts)
    # A vector's goal: the parts of its neighbours and, as much again, its own.
    goal = np.zeros((len(x), parts))
    np.add.at(goal, (np.repeat(np.arange(len(x)), graph.shape[1]), label[graph.ravel()]), 0.5 / graph.shape[1])
    goal[np.arange(len(x)), label] += 0.5
    return train_router(x, goal)


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part: same length as most, finite, not zero, with a key."""
    v = F.col(vector).cast("array<double>")
    finite = ~F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    good = df.select(F.col(key).cast("long").alias("vec_id"), v.alias("embedding")).where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    good = good.where(finite & F.exists("embedding", lambda e: e != 0))
    sizes = good.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return good.where(F.size("embedding") == (sizes[0].dim if sizes else 0))


def rerank(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k vectors of largest cosine for each query, of one block; ties to smaller ids; an id counts once.

    A matrix product proposes; the score itself is summed the same way for
    every pair, so equal vectors have equal scores wherever they lie.
    """
    out = []
    lengths, own = np.sqrt((vectors * vectors).sum(axis=1)), np.sqrt((queries * queries).sum(axis=1))
    rough = (queries / own[:, None]) @ (vectors / lengths[:, None]).T
    for i, query in enumerate(query_ids.tolist()):
        row = np.where(ids == query, -np.inf, rough[i])
        wanted = k
        while True:
            bar = np.partition(row, len(row) - wanted)[len(row) - wanted] if wanted < len(row) else -np.inf
            near = np.flatnonzero((row >= bar - 1e-9) & (row > -np.inf))
            score = (vectors[near] * queries[i]).sum(axis=1) / (lengths[near] * own[i])
            order = np.lexsort((ids[near], -score))
            _, first = np.unique(ids[near][order], return_index=True)
            if len(first) >= k or wanted >= len(row):
                break
            wanted *= 4  # several rows had the same id
        for j in order[np.sort(first)[:k]]:
            out.append((query, int(ids[near[j]]), float(score[j])))
    return out


def nearest(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", mass: float = MASS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every row where ``is_query``, a condition on ``vec_id``.

    Nearness is the cosine in double precision, ties go to the smaller id, and a
    row is no candidate of its own id. Vectors that are null or zero, that hold null or non-finite
    components, or whose length is not the most frequent one take no part, nor do rows without
    id. A repeated id counts once per query, with its best score; a repeated query uses its
    smallest vector. With ``k`` candidates or fewer all are returned.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "nearest")
    rows = usable(df, key, vector)
    sampled = rows.orderBy(F.xxhash64("vec_id", "embedding")).limit(SAMPLE).toArrow()
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router = fit_router(matrix(sampled.column("embedding").combine_chunks()), total)
    shared = spark.sparkContext.broadcast(router)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chances = shared.value.chances(units(matrix(batch.column("embedding"))))
                part = chances.argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], names=[*batch.schema.names, "part"])

    index = scratch.store(rows.mapInArrow(place, "vec_id long, embedding array<double>, part int"))
    held = {r.part: r["count"] for r in index.groupBy("part").count().collect()}
    filled = np.array([held.get(p, 0) for p in range(len(router.b2))])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            chances = shared.value.chances(units(matrix(batch.column("embedding"))))
            order = np.argsort(-chances, axis=1, kind="stable")
            reached = np.cumsum(np.take_along_axis(chances, order, axis=1), axis=1)
            seen = np.cumsum(filled[order], axis=1)
            # A part is visited while those before it have not reached the mass or the least number.
            goes = np.hstack([np.ones((len(order), 1), dtype=bool), (reached[:, :-1] < mass) | (seen[:, :-1] < LEAST_SEEN)]) & (filled[order] > 0)
            who, which = np.nonzero(goes)
            yield pa.RecordBatch.from_arrays(
                [c.take(pa.array(who)) for c in batch.columns] + [pa.array(order[who, which].astype(np.int32))], names=[*batch.schema.names, "part"])

    asked = index.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    visits = scratch.store(asked.mapInArrow(visit, "vec_id long, embedding array<double>, part int"))
    asks = {r.part: r["count"] for r in visits.groupBy("part").count().collect()}

    def pieces(counts: dict[int, int], size: int) -> Column:
        """Into how many pieces each part is split: a lookup of at most MOST_PARTS entries."""
        several = {p: -(-c // size) for p, c in counts.items() if c > size}
        if not several:
            return F.lit(1)
        table = F.create_map(*[F.lit(x) for p, n in sorted(several.items()) for x in (p, n)])
        return F.coalesce(F.element_at(table, F.col("part")), F.lit(1))

    blocks, chunks = pieces(held, BLOCK_ROWS), pieces(asks, BLOCK_QUERIES)
    slot = F.pmod(F.xxhash64("vec_id"), blocks.cast("long")).cast("int")
    turn = F.pmod(F.xxhash64("vec_id"), chunks.cast("long")).cast("int")
    left = visits.select("*", turn.alias("chunk")).select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    right = index.select("*", slot.alias("block")).select("*", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))

    def search(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        found = []
        if queries.num_rows and vectors.num_rows:
            q, v = (matrix(t.column("embedding").combine_chunks()) for t in (queries, vectors))
            found = rerank(q, queries.column("vec_id").to_numpy(), v, vectors.column("vec_id").to_numpy(), k)
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)], names=["query_id", "vec_id", "score"])

    place_by = ["part", "block", "chunk"]
    met = left.groupBy(*place_by).cogroup(right.groupBy(*place_by)).applyInArrow(search, _FOUND)
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
