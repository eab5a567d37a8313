"""Exact top-k search by inner product with KD-trees per shard."""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pannier.sources.scratch import Scratch

LEAF = 64
SHARD_ROWS, BLOCK_QUERIES = 32_768, 2_048  # sizes of a shard and of a block of queries on average


class KDTree:
    """Median splits down to leaves of ``LEAF`` points; every node has its tight box."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        low, high = [], []
        stack = [(np.arange(len(ids)), -1, 0)]
        while stack:
            rows, parent, side = stack.pop()
            node = len(low)
            if parent >= 0:
                self.children[parent][side] = node
            inside = points[rows]
            low.append(inside.min(axis=0))
            high.append(inside.max(axis=0))
            if len(rows) <= LEAF:
                self.children.append(None)
                self.rows.append(rows)
                continue
            axis = int(np.argmax(high[-1] - low[-1])) if points.shape[1] else 0
            middle = len(rows) // 2
            values = inside[:, axis] if points.shape[1] else np.zeros(len(rows))
            order = np.argpartition(values, middle)
            self.children.append([0, 0])
            self.rows.append(None)
            stack += [(rows[order[:middle]], node, 0), (rows[order[middle:]], node, 1)]
        self.low, self.high = np.array(low, np.float64), np.array(high, np.float64)
        self.ids, self.points = ids, points

    def search(self, name: int, query: np.ndarray, k: int, least: float) -> list[tuple[int, int]]:
        """(score, id) of the best ``k`` points scoring ``least`` or more, but for the query itself.

        Nodes are taken best bound first; the search ends when no box can reach the kth score
        so far. A box that can only equal it is still opened, for smaller ids.
        """
        wide = query.astype(np.float64)
        bounds = np.maximum(wide, 0) @ self.high.T + np.minimum(wide, 0) @ self.low.T
        # Beyond 2**53 sums are rounded; the bound is raised by more than the error.
        bounds += np.abs(bounds) * 1e-12
        best: list[tuple[int, int]] = []  # heap of (score, -id)
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            rows = self.rows[node]
            scores = self.points[rows] @ query
            for at in np.flatnonzero(scores >= least):
                found = (int(scores[at]), -int(self.ids[rows[at]]))
                if -found[1] == name:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(score, -at) for score, at in best]


def quantised(embedding: str | Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of every component, or NULL where the vector has no finite place."""
    parts = F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    finite = F.forall(
        embedding,
        lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")), F.lit(False)),
    )
    return F.when(F.coalesce(finite, F.lit(False)), parts)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), -1)


def _search(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(shard) and len(queries):
            tree = KDTree(shard["vec_id"].to_numpy(), _matrix(shard["vector"]))
            for name, query, least in zip(queries["vec_id"], _matrix(queries["vector"]), queries["least"]):
                found += [(name, at, score) for score, at in tree.search(name, query, k, least)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return search


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    embedding: str = "embedding",
    scale: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` best other rows by inner product.

    Rows are dealt to shards by a hash, and a shard's KD-tree is built by the task that
    searches it. A first pass searches each query in one shard; its kth score is where the
    second pass, blocks of queries against all shards, starts from, so most boxes are never
    opened. Shards and blocks have a bounded size; their numbers grow with the table.

    Vectors that are NULL or hold NULL or non-finite components, and rows without a key, take
    no part; only vectors of the same length are compared. Equal vectors with different keys
    are different rows; ties go to the smaller key. Equal rows are folded to one. Different
    vectors under one key are all candidates, and its queries share one ranking.
    Tables without queries or candidates give an empty result. Scores are 64-bit integers.
    """
    rows = vectors.select(
        F.col(key).cast("bigint").alias("vec_id"), quantised(embedding, scale).alias("vector"), is_query.alias("asks")
    ).filter("vec_id IS NOT NULL AND vector IS NOT NULL")
    rows = rows.groupBy("vec_id", "vector").agg(F.max("asks").alias("asks"))
    rows = Scratch.of(vectors.sparkSession).keep(rows.withColumn("dim", F.size("vector")), "vectors")
    n, asked = rows.count(), rows.filter("asks").count()
    shards, blocks = max(1, math.ceil(n / SHARD_ROWS)), max(1, math.ceil(asked / BLOCK_QUERIES))
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)))
    queries = sharded.filter("asks").select(
        *(F.col(name).alias(name) for name in ("vec_id", "vector", "dim", "shard")),  # columns apart from the candidates'
        F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(blocks)).alias("block"),
    )
    found = "query_id bigint, vec_id bigint, score bigint"
    near = (
        sharded.groupBy("dim", "shard")
        .cogroup(queries.withColumn("least", F.lit(float("-inf"))).groupBy("dim", "shard"))
        .applyInPandas(_search(k), found)
    )
    near = Scratch.of(vectors.sparkSession).keep(near, "near")
    reached = near.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    reached = reached.select("query_id", F.when(F.col("n") >= k, F.col("least")).alias("least"))
    asking = (
        queries.drop("shard")
        .join(reached.withColumnRenamed("query_id", "vec_id"), "vec_id", "left")
        .withColumn("least", F.coalesce(F.col("least").cast("double"), F.lit(float("-inf"))))
        .withColumn("shard", F.explode(F.expr(f"sequence(0L, {shards - 1}L)")))
    )
    offered = sharded.withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    place = ["dim", "shard", "block"]
    best = (
        offered.select("vec_id", "vector", *place)
        .groupBy(*place)
        .cogroup(asking.select("vec_id", "vector", "least", *place).groupBy(*place))
        .applyInPandas(_search(k), found)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
