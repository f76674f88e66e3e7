"""Hard-negative mining by exact search in an inverted multi-index.

Vectors are split into two halves, and each half has a codebook; the pair of
nearest codes of a vector is its cell. A query scores both halves: its inner
product with a code plus its own length times the code's radius (how far the
code's members lie from it, at most) bounds the half score of every member.
The sum of two half bounds bounds a cell. A multi-sequence heap walks the cells
in falling order of that sum: the best pair of codes first, then the next code
of either half. A query stops as soon as its answer is certified, that is when
no cell left can reach its last place, or its window.

Cells that follow each other are dealt to shards of bounded size. A query visits
shards in two rounds: first the shard of its best cell, which gives a score to
beat, then every other shard with a cell that can reach it; queries of a shard
travel in blocks. Positives are certified first, then the windows that their
scores set are searched for negatives in the same way.

Equal anchors (vector and label) are one query. Of equal rows only those with
the smallest ids can be in an answer, so a vector that a third of all rows share
is a few rows in the index.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import land


@dataclass(frozen=True)
class Params:
    """A negative's score lies in [low, high] hundredths of the positive's.
    ``sample``: vectors that the codebooks are fitted on, at most (those of
    least hash); every row is indexed. ``cell_rows``: rows of a cell, about, and
    ``codes``: codes of a half, at most. ``shard_rows``, ``query_block``: rows
    and queries of a task, about."""

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    sample: int = 16384
    rounds: int = 8
    cell_rows: int = 64
    codes: int = 128
    shard_rows: int = 8192
    query_block: int = 4096


def _codebook(points: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """k-means codes (fewer if there are fewer different points)."""
    points = np.unique(points, axis=0)
    k = max(1, min(k, len(points)))
    codes = points[np.linspace(0, len(points) - 1, k).astype(np.int64)] if len(points) else np.zeros((1, points.shape[1]))
    for _ in range(rounds):
        near = _nearest(points, codes)
        total = np.zeros_like(codes)
        np.add.at(total, near, points)
        n = np.bincount(near, minlength=len(codes))[:, None]
        codes = np.where(n > 0, total / np.maximum(n, 1), codes)
    return codes


def _nearest(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    half = 0.5 * (codes * codes).sum(axis=1)
    return np.concatenate([(half - points[lo:lo + 4096] @ codes.T).argmin(axis=1) for lo in range(0, len(points), 4096)] or [np.zeros(0, np.int64)])


class Cells:
    """What a query must know of the index: codes, radii and the shards of the
    cells, for one vector length. At most ``codes`` squared cells."""

    def __init__(self, codes: tuple[np.ndarray, np.ndarray], radii: tuple[np.ndarray, np.ndarray], shards: dict[tuple[int, int], tuple[int, int]]):
        self.codes, self.radii, self.shards = codes, radii, shards

    @cached_property
    def _lengths(self):
        return [np.linalg.norm(c, axis=1) for c in self.codes]

    def bounds(self, queries: np.ndarray) -> list[np.ndarray]:
        """Upper bounds of both half scores (queries x codes), rounded up by
        more than the arithmetic can be off."""
        h = self.codes[0].shape[1]
        out = []
        for half, codes, radii, size in zip((queries[:, :h], queries[:, h:]), self.codes, self.radii, self._lengths):
            half = half.astype(np.float64)
            norm = np.linalg.norm(half, axis=1)[:, None]
            out.append(half @ codes.T + norm * radii * (1 + 1e-9) + norm * size * 1e-9 + 1e-6)
        return out


def multi_sequence(first: np.ndarray, second: np.ndarray, cells):
    """(bound, cell) for the pairs of codes in ``cells``, highest sum first."""
    a, b = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
    x, y = first[a].tolist(), second[b].tolist()
    heap = [(-(x[0] + y[0]), 0, 0)] if a and b else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        if (a[i], b[j]) in cells:
            yield -bound, (a[i], b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):  # a row of pairs opens when the one before has begun
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))


class Best:
    """The best few of the scores in a window, ties to smaller ids. ``floor``:
    a score that as many rows elsewhere reach, or the window's lower end."""

    def __init__(self, n: int, low: float, high: float, floor: float = -np.inf):
        self.n, self.high, self.floor, self.items = n, high, max(low, floor), []

    @property
    def need(self) -> float:
        """Scores below this are of no use."""
        return max(self.floor, self.items[0][0]) if len(self.items) == self.n else self.floor

    def add(self, score: int, vec_id: int, key: int) -> None:
        if self.need <= score <= self.high:
            item = (score, -vec_id, -key)
            if len(self.items) < self.n:
                heapq.heappush(self.items, item)
            elif item > self.items[0]:
                heapq.heapreplace(self.items, item)


class Shard:
    """Rows of some cells, sorted by cell."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["c1", "c2"], kind="stable")
        self.points = _matrix(rows["v"])
        self.top = int(np.abs(self.points).max(initial=0))
        self._float = self.points.astype(np.float64)
        self.ids, self.keys, self.labels = (rows[c].to_numpy() for c in ("vec_id", "key", "label"))
        pairs = rows[["c1", "c2"]].to_numpy()
        edge = np.flatnonzero(np.any(pairs[1:] != pairs[:-1], axis=1)) + 1
        begin, end = [0, *edge.tolist()], [*edge.tolist(), len(rows)]
        # The codes that occur here; cells are numbered by them, so that the heap meets few empty ones.
        self.first, self.second = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
        i, j = np.searchsorted(self.first, pairs[begin, 0]), np.searchsorted(self.second, pairs[begin, 1])
        self.cells = dict(zip(zip(i.tolist(), j.tolist()), zip(begin, end)))

    def scores(self, a: int, b: int, query: np.ndarray) -> np.ndarray:
        # Inner products below 2**53 are exact as doubles, and doubles multiply faster.
        if self.top * int(np.abs(query).max(initial=0)) * max(1, len(query)) < 1 << 52:
            return (self._float[a:b] @ query.astype(np.float64)).astype(np.int64)
        return self.points[a:b] @ query

    def search(self, query: np.ndarray, label: int, same: bool, first: np.ndarray, second: np.ndarray, windows: list[Best]) -> None:
        """Fill the windows from the rows that have the label (or do not).
        ``first``, ``second``: the query's half bounds."""
        high = max(w.high for w in windows)
        for bound, cell in multi_sequence(first[self.first], second[self.second], self.cells):
            need = min(w.need for w in windows)
            if bound < need:
                break  # certified: no cell left reaches any window
            a, b = self.cells[cell]
            scores = self.scores(a, b, query)
            fit = ((self.labels[a:b] == label) == same) & (scores >= need) & (scores <= high)
            for i in np.flatnonzero(fit).tolist():
                for w in windows:
                    w.add(int(scores[i]), int(self.ids[a + i]), int(self.keys[a + i]))


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.int64) if len(vectors) else np.zeros((0, 0), np.int64)


def score_window(positive: int, params: Params) -> tuple[int, int]:
    """The lowest and highest score of a negative."""
    return -(-params.low * positive // 100), params.high * positive // 100


def _windows(scores, floors, params: Params) -> list[Best]:
    """One window per positive score; without any, the open window of the positives."""
    if scores is None:
        return [Best(params.positives + 1, -np.inf, np.inf, -np.inf if floors[0] is None else floors[0])]
    return [Best(params.negatives, *score_window(s, params), -np.inf if f is None else f) for s, f in zip(scores, floors)]


class Index:
    """The landed rows (key, vec_id, label, v, dim, c1, c2, shard) and, per
    vector length, what routing needs."""

    def __init__(self, rows: DataFrame, params: Params):
        """``rows``: key, vec_id, label, v, dim; landed."""
        self.params, spark = params, rows.sparkSession
        sizes = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
        total = sum(sizes.values())
        share = min(1 << 20, -(-(3 * params.sample << 20) // (2 * max(1, total))))
        chosen = rows.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < share).orderBy(F.xxhash64("v"), "key").limit(params.sample)
        sample = chosen.select("dim", "v").toPandas()
        codes = {}
        for dim, n in sizes.items():
            part, half = sample[sample["dim"] == dim]["v"], dim // 2
            points = _matrix(part).astype(np.float64) if len(part) else np.zeros((0, dim))
            k = min(params.codes, int(np.ceil(np.sqrt(n / params.cell_rows))))
            codes[dim] = (_codebook(points[:, :half], k, params.rounds), _codebook(points[:, half:], k, params.rounds))
        books = spark.sparkContext.broadcast(codes)

        def assign(frames):
            for frame in frames:
                for dim, part in frame.groupby("dim"):
                    points, half = _matrix(part["v"]).astype(np.float64), dim // 2
                    out = {"key": part["key"]}
                    for i, (x, book) in enumerate(zip((points[:, :half], points[:, half:]), books.value[dim]), 1):
                        near = _nearest(x, book) if len(x) else np.zeros(0, np.int64)
                        out |= {f"c{i}": near, f"r{i}": np.linalg.norm(x - book[near], axis=1)}
                    yield part.assign(**out)

        coded = land(rows.mapInPandas(assign, "key long, vec_id long, label string, v array<long>, dim int, c1 int, c2 int, r1 double, r2 double"), "cells")
        cells = coded.groupBy("dim", "c1", "c2").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).toPandas()
        self.cells, shards = {}, 0
        for dim, part in cells.sort_values(["dim", "c1", "c2"]).groupby("dim"):
            radii = [np.zeros(len(b)) for b in codes[dim]]
            np.maximum.at(radii[0], part["c1"].to_numpy(), part["r1"].to_numpy())
            np.maximum.at(radii[1], part["c2"].to_numpy(), part["r2"].to_numpy())
            limit, filled, places = self._limit(dim, params.shard_rows), 0, {}
            for c1, c2, n in zip(part["c1"].tolist(), part["c2"].tolist(), part["n"].tolist()):
                if filled and filled + n > limit:
                    shards, filled = shards + 1, 0
                pieces = -(-n // limit)  # a cell above the limit has shards of its own
                places[(c1, c2)] = (shards, pieces)
                shards, filled = (shards, filled + n) if pieces == 1 else (shards + pieces, 0)
            shards += 1
            self.cells[dim] = Cells(codes[dim], tuple(radii), places)
        self.shards = shards
        self.shared = spark.sparkContext.broadcast(self.cells)
        self.rows = coded.withColumn("shard", self._shard()("dim", "c1", "c2", F.xxhash64("key")))

    @staticmethod
    def _limit(dim: int, rows: int) -> int:
        """Rows of a task: fewer where vectors are long."""
        return max(64, min(rows, (1 << 22) // max(1, dim)))

    def _shard(self):
        shared = self.shared

        @F.pandas_udf("long")
        def shard(dim: pd.Series, c1: pd.Series, c2: pd.Series, h: pd.Series) -> pd.Series:
            places = [shared.value[d].shards[(a, b)] for d, a, b in zip(dim.tolist(), c1.tolist(), c2.tolist())]
            first, pieces = np.array(places, np.int64).reshape(-1, 2).T
            return pd.Series(first + h.to_numpy() % pieces)

        return shard

    def route(self, queries: DataFrame, home: bool) -> DataFrame:
        """``queries`` (q, label, v, dim, scores, floors) with ``shard``: the
        first of the best cell, or all others with a cell that can reach a window."""
        shared, params = self.shared, self.params

        def shards(frames):
            for frame in frames:
                found = []
                for dim, part in frame.groupby("dim"):
                    cells = shared.value.get(dim)
                    if cells is None:
                        continue
                    for lo in range(0, len(part), 1024):
                        some = part.iloc[lo:lo + 1024]
                        firsts, seconds = cells.bounds(_matrix(some["v"]))
                        for n, (q, scores, floors) in enumerate(zip(some["q"], some["scores"], some["floors"])):
                            need = min((w.need for w in _windows(scores, _floors(floors), params)), default=np.inf)
                            mine, to = None, set()
                            for bound, cell in multi_sequence(firsts[n], seconds[n], cells.shards):
                                if mine is not None and (home or bound < need):
                                    break
                                at, pieces = cells.shards[cell]
                                mine = at if mine is None else mine
                                if bound >= need:
                                    to.update(range(at, at + pieces))
                            found += [(q, mine)] if home and mine is not None else [(q, t) for t in to - {mine}] if not home else []
                yield pd.DataFrame(found, columns=["to", "shard"]).astype("int64")

        to = land(queries.select("q", "v", "dim", "scores", "floors").mapInPandas(shards, "to long, shard long"), "routes")
        return queries.join(to, F.col("q") == F.col("to")).drop("to")

    def visit(self, routed: DataFrame, same: bool) -> DataFrame:
        """Rows (q, place, score, vec_id, key): what each window of a query finds in a shard."""
        shared, params = self.shared, self.params
        # Queries per block: a shard that many queries visit is read by several tasks.
        load = routed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("dim").alias("d")).select(
            F.col("shard").alias("at"), F.ceil(F.col("n") / F.greatest(F.lit(64), F.least(F.lit(params.query_block), F.expr(f"{1 << 22} div greatest(1, d)"))))
            .cast("long").alias("blocks"))
        load = land(load, "visits")
        asked = routed.join(load, F.col("shard") == F.col("at")).withColumn("block", F.pmod(F.xxhash64("q"), F.col("blocks")))
        asked = asked.select(F.col("shard").alias("q_shard"), F.col("block").alias("q_block"), F.col("q"), F.col("label").alias("q_label"),
                             F.col("v").alias("q_v"), F.col("dim").alias("q_dim"), "scores", "floors")
        there = self.rows.join(load, F.col("shard") == F.col("at")).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))

        def look(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(rows) and len(queries):
                shard, cells = Shard(rows), shared.value[int(rows["dim"].iloc[0])]
                for lo in range(0, len(queries), 1024):
                    some = queries.iloc[lo:lo + 1024]
                    points = _matrix(some["q_v"])
                    firsts, seconds = cells.bounds(points)
                    for n, (q, label, scores, floors) in enumerate(zip(some["q"], some["q_label"], some["scores"], some["floors"])):
                        windows = _windows(scores, _floors(floors), params)
                        if windows:
                            shard.search(points[n], label, same, firsts[n], seconds[n], windows)
                        found += [(q, place, s, -i, -k) for place, w in enumerate(windows) for s, i, k in w.items]
            return pd.DataFrame(found, columns=["q", "place", "score", "vec_id", "key"]).astype("int64")

        return (there.select("shard", "block", "key", "vec_id", "label", "v", "dim", "c1", "c2").groupBy("shard", "block")
                .cogroup(asked.groupBy("q_shard", "q_block")).applyInPandas(look, "q long, place long, score long, vec_id long, key long"))

    def best(self, queries: DataFrame, same: bool, n: int, name: str) -> DataFrame:
        """The ``n`` best rows of every window of ``queries`` (q, label, v, dim, scores)."""
        windows = F.when(F.col("scores").isNull(), 1).otherwise(F.size("scores"))
        none = F.array_repeat(F.lit(None).cast("long"), windows)
        near = land(self.visit(self.route(queries.withColumn("floors", none), True), same), f"{name}-home")
        reached = near.groupBy(F.col("q").alias("of"), "place").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        reached = reached.filter(F.col("n") >= n).groupBy("of").agg(F.map_from_entries(F.collect_list(F.struct("place", "least"))).alias("reached"))
        floors = F.transform(F.sequence(F.lit(0).cast("long"), windows.cast("long") - 1), lambda w: F.element_at("reached", w))
        floored = queries.join(reached, F.col("q") == F.col("of"), "left").withColumn(
            "floors", F.when(windows == 0, none).when(F.col("reached").isNull(), none).otherwise(floors)).drop("of", "reached")
        found = near.unionByName(self.visit(self.route(floored, False), same))
        order = Window.partitionBy("q", "place").orderBy(F.desc("score"), "vec_id", "key")
        return land(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n), name)


def _floors(floors) -> list:
    return [None if pd.isna(f) else int(f) for f in floors]


def mine(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         params: Params = Params()) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for every row with ``is_anchor`` and each of its
    ``positives`` best other rows of the same label, the first ``negatives`` rows
    of another label whose score lies in the positive's window.

    A score is the integer inner product with the anchor, of floor(scale * x);
    ties go to the smaller id. Rows with a null id, label or vector, or a vector
    with a null or non-finite component, take no part; vectors of different
    lengths have no product. Repeated rows are rows of their own: an anchor's
    twin may be its positive, and both are anchors. Fewer rows, or none, in a
    window give fewer or none; no anchor gives none. Scaled components must fit
    a long, and scores too."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull()).filter(~bad).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        F.transform(x, lambda c: F.floor(F.lit(float(params.scale)) * c.cast("double")).cast("long")).alias("v"),
        F.monotonically_increasing_id().alias("key"))
    rows = land(rows.withColumn("dim", F.size("v")), "vectors")
    order = Window.partitionBy("v", "label").orderBy("vec_id", "key")
    several = max(params.positives + 1, params.negatives)
    kept = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= several).select("key", "vec_id", "label", "v", "dim")
    index = Index(land(kept, "index-rows"), params)

    anchors = rows.filter("is_anchor")
    queries = land(anchors.groupBy("v", "label", "dim").agg(F.min("key").alias("q")), "queries")
    # One more than an anchor's positives: the anchor itself may be among them.
    found = index.best(queries.withColumn("scores", F.lit(None).cast("array<long>")), True, params.positives + 1, "positives")
    near = found.groupBy(F.col("q").alias("of")).agg(
        F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id", "key"))).alias("positives")).withColumn(
        "scores", F.array_distinct("positives.score"))
    near = land(queries.join(near, F.col("q") == F.col("of")).drop("of"), "query-positives")
    found = index.best(near.select("q", "label", "v", "dim", "scores"), False, params.negatives, "negatives")
    far = found.groupBy(F.col("q").alias("of"), "place").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "vec_id"))).alias("list"))
    far = far.groupBy("of").agg(F.map_from_entries(F.collect_list(F.struct("place", "list"))).alias("negatives"))
    answer = near.join(far, F.col("q") == F.col("of")).select(F.col("v").alias("qv"), F.col("label").alias("ql"), "positives", "scores", "negatives")

    each = anchors.select("key", "vec_id", "v", "label").join(answer, (F.col("v") == F.col("qv")) & (F.col("label") == F.col("ql")))
    own = F.slice(F.filter("positives", lambda p: p["key"] != F.col("key")), 1, params.positives)
    each = each.select(F.col("vec_id").alias("anchor_id"), "scores", "negatives", F.explode(own).alias("p"))
    each = each.withColumn("n", F.explode(F.element_at("negatives", F.array_position("scores", F.col("p.score")) - 1)))
    return each.select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("n.rank").cast("int").alias("rank"),
                       F.col("n.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"))
