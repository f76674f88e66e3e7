"""Exact top-k inner-product search with a KD-tree per shard.

Vectors are dealt into shards of bounded size. A shard's KD-tree splits at the
median of the widest dimension and keeps a tight box per node; the best inner
product that a box can hold bounds every vector in it. A query walks a tree
best box first and stops when no box can reach its kth score.

First every query searches its own shard; the kth score found there goes with
it to all other shards, where boxes below it are never opened. Queries travel
in blocks: a task holds one shard and one block of queries.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import land


NO_FLOOR = -(1 << 63)  # below every score


@dataclass(frozen=True)
class Params:
    """``shard_rows``: vectors of a shard, about. ``query_block``: queries that
    meet a shard in one task, about."""

    k: int = 10
    scale: int = 1024
    shard_rows: int = 8192
    query_block: int = 16384
    leaf: int = 64


class KDTree:
    """Over integer vectors (rows); ``ids`` break ties, smaller first."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int):
        self.points, self.top = points, int(np.abs(points).max(initial=0))
        self.ids, self.order = ids, np.arange(len(points))
        self.left, self.right, self.low, self.high, self.span = [], [], [], [], []
        stack = [(0, len(points), -1, False)]
        while stack:
            a, b, parent, is_right = stack.pop()
            node = len(self.span)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            part = self.points[self.order[a:b]]
            lo, hi = part.min(axis=0), part.max(axis=0)
            self.low.append(lo)
            self.high.append(hi)
            self.span.append((a, b))
            self.left.append(-1)
            self.right.append(-1)
            if b - a > leaf and part.shape[1]:
                axis = int(np.argmax(hi - lo))
                half = (b - a) // 2
                self.order[a:b] = self.order[a:b][np.argpartition(part[:, axis], half)]
                stack.append((a + half, b, node, True))
                stack.append((a, a + half, node, False))
        self.points, self.ids = self.points[self.order], self.ids[self.order]
        self.low, self.high = np.array(self.low, np.float64), np.array(self.high, np.float64)
        self._far = np.maximum(np.abs(self.low), np.abs(self.high))
        self._doubles = self.points.astype(np.float64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product any vector in each node's box can have
        (queries x nodes), raised by more than doubles can round it off."""
        q = queries.astype(np.float64)
        slack = np.abs(q) @ self._far.T * (1e-15 * (q.shape[1] + 2))
        return np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T + slack

    def scores(self, a: int, b: int, query: np.ndarray) -> np.ndarray:
        # Inner products below 2**53 are exact as doubles, and doubles multiply faster.
        if self.top * int(np.abs(query).max(initial=0)) * max(1, len(query)) < 1 << 52:
            return (self._doubles[a:b] @ query.astype(np.float64)).astype(np.int64)
        return self.points[a:b] @ query

    def search(self, query: np.ndarray, bound: np.ndarray, own: int, keys: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, row) of the best ``k`` (or those that reach ``floor``), best
        first; the row whose key is ``own`` takes no part."""
        best: list[tuple[int, int, int]] = []  # a heap: the worst kept (lowest score, then largest id) on top
        boxes = [(-bound[0], 0)]
        while boxes:
            ceiling, node = heapq.heappop(boxes)
            kth = max(floor, best[0][0]) if len(best) == k else floor
            if -ceiling < kth:
                break
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    if bound[child] >= kth:
                        heapq.heappush(boxes, (-bound[child], child))
                continue
            a, b = self.span[node]
            scores = self.scores(a, b, query)
            for i in np.flatnonzero(scores >= kth).tolist():
                row = a + i
                if keys[row] == own:
                    continue
                item = (int(scores[i]), -int(self.ids[row]), row)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, row) for s, _, row in sorted(best, reverse=True)]


def _frame(found: list[tuple[int, int, int, int]]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=["key", "query_id", "vec_id", "score"]).astype("int64")


def _search(vectors: pd.DataFrame, queries: pd.DataFrame, params: Params) -> pd.DataFrame:
    if not len(vectors) or not len(queries):
        return _frame([])
    dim = len(vectors["v"].iloc[0])
    points = np.stack(vectors["v"].to_list()).astype(np.int64).reshape(len(vectors), dim)
    tree = KDTree(points, vectors["vec_id"].to_numpy(), params.leaf)
    keys = vectors["key"].to_numpy()[tree.order]
    out = []
    for lo in range(0, len(queries), 1024):
        part = queries.iloc[lo:lo + 1024]
        q = np.stack(part["v"].to_list()).astype(np.int64).reshape(len(part), dim)
        bounds = tree.bounds(q)
        for i, (own, query_id, floor) in enumerate(zip(part["key"], part["vec_id"], part["floor"])):
            got = tree.search(q[i], bounds[i], own, keys, params.k, floor)
            out += [(own, query_id, int(tree.ids[row]), score) for score, row in got]
    return _frame(out)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", params: Params = Params()) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for every row with ``is_query`` the
    ``k`` other rows of largest integer inner product, ties to the smaller id.

    Components become floor(scale * x). Rows with a null id, a null vector, or
    a vector with a null or non-finite component take no part; vectors of
    different lengths have no product. Repeated rows are rows of their own: a
    query's twin is a candidate. Fewer candidates give fewer rows; no query
    gives none. Scaled components must fit a long, and scores too."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & x.isNotNull()).filter(~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.transform(x, lambda c: F.floor(F.lit(float(params.scale)) * c.cast("double")).cast("long")).alias("v"),
        F.monotonically_increasing_id().alias("key"))
    rows = land(rows.withColumn("dim", F.size("v")), "vectors")
    n, nq = rows.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_query"), 1))).first()
    shards, blocks = max(1, -(-n // params.shard_rows)), max(1, -(-nq // params.query_block))
    rows = rows.withColumns({"shard": F.pmod(F.xxhash64("key"), F.lit(shards)), "block": F.pmod(F.xxhash64("key", F.lit(1)), F.lit(blocks))})

    kinds = "key long, query_id long, vec_id long, score long"

    def own_shard(frame: pd.DataFrame) -> pd.DataFrame:
        return _search(frame, frame[frame["is_query"]].assign(floor=NO_FLOOR), params)

    home = land(rows.groupBy("dim", "shard").applyInPandas(own_shard, kinds), "own-shard")
    kth = home.groupBy("key").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).select(
        F.col("key").alias("q"), F.when(F.col("n") == params.k, F.col("least")).alias("floor"))
    asked = rows.filter("is_query").join(kth, F.col("key") == F.col("q"), "left").select(
        "dim", "shard", "block", "key", "vec_id", "v", F.coalesce("floor", F.lit(NO_FLOOR)).alias("floor"))
    if shards > 1:
        sent = asked.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).filter(F.col("to") != F.col("shard"))
        sent = sent.select("dim", F.col("to").cast("long").alias("shard"), "block", "key", "vec_id", "v", "floor")
        there = rows.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block"), "key", "vec_id", "v")

        names = sent.columns
        sent = sent.select(*(F.col(c).alias(f"q_{c}") for c in names))  # names of their own: both sides come from one table

        def other_shard(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            return _search(vectors, queries.set_axis(names, axis=1), params)

        away = (there.groupBy("dim", "shard", "block").cogroup(sent.groupBy("q_dim", "q_shard", "q_block"))
                .applyInPandas(other_shard, kinds))
        home = home.union(away)
    return _ranked(home, params.k).select("query_id", "rank", "vec_id", "score")
