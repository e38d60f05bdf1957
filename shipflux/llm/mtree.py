"""Exact top-k by inner product with M-trees and best-first search.

A tree needs a metric, so every vector x gets one more component,
sqrt(M - |x|^2) with M the largest |x|^2 of all, and a query gets 0: then
distance^2 = |q|^2 + M - 2 <q, x>, and the nearest are those of largest product.

Every task builds trees over its own vectors, a shard at a time, and searches
them for all queries of a block. Nodes are pages with a routing vector, a
covering radius and, for every entry, the distance to it (the parent distance).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipflux.llm.common import share

PAGE = 128
FANOUT = 16
# Vectors of one tree, and queries of one pass over the vectors.
SHARD_ROWS = 50_000
BLOCK_QUERIES = 20_000
SCALE = 1024


@dataclass
class Node:
    """A page: routing vector, covering radius, parent distances of its entries (nodes, or rows of the shard)."""

    routing: np.ndarray
    radius: float
    apart: np.ndarray
    entries: list[Node] | np.ndarray


def distances(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(np.square(points - one).sum(axis=1))


def clustered(points: np.ndarray, count: int) -> np.ndarray:
    """The nearest of `count` evenly drawn routing points, for every point."""
    routes = points[np.linspace(0, len(points) - 1, count).astype(np.int64)]
    gaps = -2 * points @ routes.T + np.square(routes).sum(axis=1)
    return np.argmin(gaps, axis=1)


def grow(points: np.ndarray) -> Node | None:
    """A tree over the rows of `points`, bulk-loaded: pages of rows, then pages of pages."""
    if not len(points):
        return None
    leaves: list[Node] = []
    owner = clustered(points, max(1, -(-len(points) // PAGE)))
    for group in np.unique(owner):
        rows = np.flatnonzero(owner == group)
        routing = points[rows].mean(axis=0)
        apart = distances(points[rows], routing)
        order = np.argsort(apart, kind="stable")
        for at in range(0, len(rows), PAGE):
            cut = order[at : at + PAGE]
            leaves.append(Node(routing, float(apart[cut].max()), apart[cut], rows[cut]))
    level = leaves
    while len(level) > 1:
        centres = np.array([n.routing for n in level])
        owner = clustered(centres, max(1, -(-len(level) // FANOUT)))
        above: list[Node] = []
        for group in np.unique(owner):
            members = np.flatnonzero(owner == group)
            for at in range(0, len(members), FANOUT):
                nodes = [level[i] for i in members[at : at + FANOUT]]
                routing = np.mean([n.routing for n in nodes], axis=0)
                apart = distances(np.array([n.routing for n in nodes]), routing)
                radius = max(float(a) + n.radius for a, n in zip(apart, nodes, strict=True))
                above.append(Node(routing, radius, apart, nodes))
        level = above
    return level[0]


def search(
    root: Node, vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, largest: float, k: int
) -> list[tuple[int, int]]:
    """The k best (score, id) of a tree, ties to the smaller id; a row of the query's own id is no candidate."""
    point = np.append(query.astype(np.float64), 0.0)
    total = float(query.astype(np.float64) @ query.astype(np.float64)) + largest
    slack = 1e-9 * total + 1e-6

    def best_score(gap: float | np.ndarray):
        """No product at this distance or farther is larger."""
        return (total - np.square(np.maximum(gap, 0.0))) / 2 + slack

    found: list[tuple[int, int]] = []
    gap = float(np.sqrt(np.square(root.routing - point).sum()))
    queue = [(-float(best_score(gap - root.radius)), 0, gap, root)]
    pushed = 1
    while queue:
        bound, _, gap, node = heapq.heappop(queue)
        least = found[-1][0] if len(found) == k else None
        if least is not None and -bound < least:
            break
        # |d(query, routing) - d(entry, routing)| bounds an entry before its distance is worked out.
        lower = np.abs(gap - node.apart)
        if isinstance(node.entries, np.ndarray):
            rows = node.entries
            if least is not None:
                rows = rows[best_score(lower) >= least]
            rows = rows[ids[rows] != own]
            scores = vectors[rows] @ query
            found = sorted([*found, *zip(scores.tolist(), ids[rows].tolist(), strict=True)], key=lambda m: (-m[0], m[1]))[:k]
            continue
        for child, near in zip(node.entries, lower, strict=True):
            if least is not None and best_score(near - child.radius) < least:
                continue
            exact = float(np.sqrt(np.square(child.routing - point).sum()))
            heapq.heappush(queue, (-float(best_score(exact - child.radius)), pushed, exact, child))
            pushed += 1
    return found


def whole_numbers(rows: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """(vec_id, vector): floor(scale * x), without vectors that are null or hold null or non-finite numbers."""
    x = F.transform(F.col(embedding), lambda v: v.cast("double"))
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.filter(F.col(embedding).isNotNull() & usable).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(v * scale)).alias("vector"),
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), dtype=np.int64)


def top_k(
    rows: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = 10,
    scale: int = SCALE,
    block: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of largest product with each query.

    Vectors that are null, or hold null or non-finite components, take no part.
    Vectors of another length than the query's are no candidates; empty vectors
    score 0. A row with the query's id is its own and no candidate; queries with
    one id are one query (its smallest vector), repeated candidates rank one by
    one. Rows with a null id take no part. Fewer candidates than k give fewer rows.

    Queries go to all tasks in blocks of `block`; a task keeps k rows per query.
    """
    spark = rows.sparkSession
    vectors = whole_numbers(rows, vec_id, embedding, scale).filter("vec_id IS NOT NULL")
    asked = whole_numbers(queries, vec_id, embedding, scale).filter("vec_id IS NOT NULL")
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    largest = vectors.agg(F.max(norm)).first()[0] or 0.0
    result = None
    for held in query_blocks(asked, block):
        sent = share(spark, held)
        part = vectors.mapInArrow(searching(sent, largest, k), "query_id long, vec_id long, score long")
        result = part if result is None else result.union(part)
    if result is None:
        result = spark.createDataFrame([], "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = result.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query_blocks(asked: DataFrame, block: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    held: list[tuple[int, np.ndarray]] = []
    for row in asked.toLocalIterator():
        held.append((row["vec_id"], np.array(row["vector"], dtype=np.int64)))
        if len(held) == block:
            yield held
            held = []
    if held:
        yield held


def searching(sent, largest: float, k: int):
    def shard(ids: np.ndarray, vectors: np.ndarray) -> list[tuple[int, int, int]]:
        points = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(largest - np.square(points).sum(axis=1), 0.0))
        root = grow(np.concatenate([points, rest[:, None]], axis=1))
        out = []
        for own, query in sent.value:
            if root is not None and len(query) == vectors.shape[1]:
                out += [(own, at, score) for score, at in search(root, vectors, ids, query, own, largest, k)]
        return out

    def flushed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        found = shard(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
        columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        rows: dict[int, int] = {}
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                waiting.setdefault(int(size), []).append(
                    (part.column("vec_id").to_numpy(), matrix(part.column("vector")).reshape(part.num_rows, int(size)))
                )
                rows[int(size)] = rows.get(int(size), 0) + part.num_rows
                if rows[int(size)] >= SHARD_ROWS:
                    yield flushed(waiting.pop(int(size)))
                    rows[int(size)] = 0
        for held in waiting.values():
            yield flushed(held)

    return run
