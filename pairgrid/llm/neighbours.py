"""Nearest neighbours by inner product with a vantage-point tree for each shard.

A vector gets one more component, the root of what its squared length lacks to the
largest one, and a query gets a zero: the nearest points in the lengthened space are
those of the largest inner product, and the triangle inequality holds there. Each shard
builds a tree: a node has a vantage point and the median distance to it, and leaves hold
a few hundred vectors. A query visits the nearer side first and the other one unless
its least possible distance, times ``factor``, is beyond the k-th best found so far.
Factor 1 is exact; larger factors prune more.

Queries are searched in blocks: a block walks a shard's tree together, and the best of
all shards meet in a ranking of k rows a shard and query.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairgrid.llm.common import query, table
from pairgrid.session import staged

LEAF = 256


#: A leaf is an array of rows; an inner node is (vantage point, radius, inside, outside).
#: Plain values, as trees are written with pickle.
Node = np.ndarray | tuple


def lengthened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """With one more component, so that all have the squared length ``longest``."""
    rest = np.sqrt(np.maximum(longest - np.einsum("ij,ij->i", vectors, vectors), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def _far(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((vectors - point) ** 2).sum(axis=1), 0))


def build(points: np.ndarray, rows: np.ndarray, leaf: int = LEAF) -> Node:
    """Tree over the given rows. The vantage point is the row farthest from the mean."""
    if len(rows) <= leaf:
        return rows
    own = points[rows]
    point = own[int(np.argmax(_far(own, own.mean(axis=0))))]
    d = _far(own, point)
    radius = float(np.median(d))
    near = d <= radius
    if near.all() or not near.any():
        near = d < radius
        if not near.any():  # all as far: nothing to part
            return rows
        radius = float(d[near].max())
    return point, radius, build(points, rows[near], leaf), build(points, rows[~near], leaf)


class Search:
    """The k best rows of one shard for a block of queries."""

    def __init__(self, vectors: np.ndarray, points: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.vectors, self.queries, self.k, self.factor = vectors, queries, k, factor
        self.points = points
        self.as_points = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1)
        self.longest = float(np.einsum("ij,ij->i", points, points).max()) if len(points) else 0.0
        self.lengths = np.einsum("ij,ij->i", queries, queries)
        self.score = np.full((len(queries), k), -np.inf)
        self.row = np.full((len(queries), k), -1, dtype=np.int64)

    def reach(self, active: np.ndarray) -> np.ndarray:
        """Distance of the k-th best so far, with room for rounding."""
        square = self.lengths[active] + self.longest - 2 * self.score[active].min(axis=1)
        return np.sqrt(np.maximum(square, 0)) + 1e-9

    def visit(self, node: Node, active: np.ndarray) -> None:
        if not len(active):
            return
        if not isinstance(node, tuple):
            found = self.queries[active] @ self.vectors[node].T
            score = np.concatenate([self.score[active], found], axis=1)
            row = np.concatenate([self.row[active], np.broadcast_to(node, found.shape)], axis=1)
            best = np.argpartition(-score, self.k - 1, axis=1)[:, : self.k]
            self.score[active] = np.take_along_axis(score, best, axis=1)
            self.row[active] = np.take_along_axis(row, best, axis=1)
            return
        point, radius, inside, outside = node
        d = _far(self.as_points[active], point)
        first = d <= radius
        self.visit(inside, active[first])
        self.visit(outside, active[~first])
        wanted = np.abs(d - radius) * self.factor <= self.reach(active)
        self.visit(outside, active[first & wanted])
        self.visit(inside, active[~first & wanted])


def _distinct(ids: np.ndarray, vectors: np.ndarray, copies: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Different vectors, and the smallest ``copies`` ids of each: more can't be among the nearest."""
    _, first, which = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    order = np.lexsort((ids, which.ravel()))
    ends = np.cumsum(np.bincount(which.ravel()))
    return vectors[first], [ids[order[a:b]][:copies] for a, b in zip([0, *ends[:-1]], ends)]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _indexed(longest: float, copies: int, leaf: int):
    def run(rows: pa.Table) -> pa.Table:
        ids, vectors = rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"))
        vectors, groups = _distinct(ids, vectors, copies)
        tree = build(lengthened(vectors, longest), np.arange(len(vectors)), leaf)
        blob = pickle.dumps((vectors, groups, tree), protocol=5)
        return pa.table({"shard": rows.column("shard")[:1], "tree": pa.array([blob], pa.binary())})

    return run


def _searched(longest: float, k: int, factor: float):
    def run(index: pa.Table, block: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if len(index) and len(block):
            vectors, groups, tree = pickle.loads(index.column("tree")[0].as_py())
            ids, queries = block.column("query_id").to_numpy(), _matrix(block.column("vector"))
            # One more than asked for, as a query's own row is no result of its.
            search = Search(vectors, lengthened(vectors, longest), queries, min(k + 1, len(vectors)), factor)
            search.visit(tree, np.arange(len(queries)))
            for q, rows in enumerate(search.row):
                rows = rows[rows >= 0]
                # Summed in the same order for equal vectors, so equal rows have equal scores.
                exact = (vectors[rows] * queries[q]).sum(axis=1)
                pairs = sorted((-s, i) for s, r in zip(exact, rows) for i in groups[r] if i != ids[q])[:k]
                out[0] += [ids[q]] * len(pairs)
                out[1] += [i for _, i in pairs]
                out[2] += [-s for s, _ in pairs]
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    factor: float = 1.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = 4096,
    block_rows: int = 4096,
    leaf: int = LEAF,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows with the largest inner product.

    Queries are the rows where ``is_query`` holds; candidates are all rows with other
    ids. Scores are inner products in double precision of the original vectors; equal
    scores go by the smaller id. With ``factor`` 1 nothing is missed. Left out, as
    queries and as candidates: null ids, and vectors that are null, empty, all zero,
    of another length than most, or hold a null or non-finite component. Repeated ids
    are rows of their own as candidates; as queries one of them counts, with the
    smallest vector. A query with fewer than k candidates gets all.
    """
    session = vectors.sparkSession
    v = F.col("vector")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0))
    square = F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x)
    # One row for each length that occurs.
    widths = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"), F.max(square).alias("longest"))
    common = widths.orderBy(F.desc("n"), "width").first()
    if common is None:
        return session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == common["width"])
    shards = -(-common["n"] // shard_rows)
    longest = float(common["longest"])
    dealt = rows.select(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).alias("shard"), "vec_id", "vector")
    index = staged(dealt.groupBy("shard").applyInArrow(_indexed(longest, k + 1, leaf), "shard long, tree binary"), "trees")
    asked = rows.where("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-asked.count() // block_rows))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")
    queries = asked.select(F.col("vec_id").alias("query_id"), "vector", block, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"))
    cells = index.select("tree", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    found = (
        cells.groupBy("shard", "block")
        .cogroup(queries.groupBy("shard", "block"))
        .applyInArrow(_searched(longest, k, factor), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


@query("op6_vantage_point_search")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, factor=1.3)
