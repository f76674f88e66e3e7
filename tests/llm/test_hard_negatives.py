import heapq
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.llm import hard_negatives as H
from tests.llm.conftest import clashing

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, scale=256, mod=50):
    """Rows are compared by place, so that repeated rows are rows of their own."""
    ok = [(i, label, [math.floor(scale * x) for x in v]) for i, v, label in rows
          if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (anchor, label, v) in enumerate(ok):
        if anchor % mod:
            continue
        score = {b: sum(x * y for x, y in zip(v, w)) for b, (_, _, w) in enumerate(ok) if len(w) == len(v) and b != a}
        rank = sorted(score, key=lambda b: (-score[b], ok[b][0], b))
        for p in [b for b in rank if ok[b][1] == label][:5]:
            fit = [b for b in rank if ok[b][1] != label and 50 * score[p] <= 100 * score[b] <= 95 * score[p]][:3]
            out += [(anchor, ok[p][0], n, ok[b][0], score[p], score[b]) for n, b in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **params):
    return sorted(tuple(r) for r in H.mine(df, F.col("vec_id") % 50 == 0, params=H.Params(**params)).collect())


def test_multi_sequence_is_in_falling_order():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=9), rng.normal(size=7)
    cells = {(i, j) for i, j in itertools.product(range(9), range(7)) if (i + j) % 3}
    got = list(H.multi_sequence(a, b, cells))
    assert {c for _, c in got} == cells and [x for x, _ in got] == sorted((a[i] + b[j] for i, j in cells), reverse=True)


def test_bounds_hold_for_every_member():
    rng = np.random.default_rng(4)
    x, q = rng.integers(-300, 300, (500, 10)).astype(float), rng.integers(-300, 300, (40, 10))
    books = tuple(H._codebook(part, 8, 5) for part in (x[:, :5], x[:, 5:]))
    codes = [H._nearest(part, book) for part, book in zip((x[:, :5], x[:, 5:]), books)]
    radii = [np.array([np.linalg.norm(part[c == k] - book[k], axis=1).max(initial=0) for k in range(len(book))])
             for part, c, book in zip((x[:, :5], x[:, 5:]), codes, books)]
    first, second = H.Cells(books, tuple(radii), {}).bounds(q)
    assert (first[:, codes[0]] + second[:, codes[1]] >= q @ x.T).all()


def test_a_search_visits_few_cells_of_clustered_rows():
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(16, 8)) * 200
    x = (centre[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 8))).astype(np.int64)
    books = (H._codebook(x[:, :4].astype(float), 16, 8), H._codebook(x[:, 4:].astype(float), 16, 8))
    c1, c2 = (H._nearest(part.astype(float), book) for part, book in zip((x[:, :4], x[:, 4:]), books))
    import pandas as pd

    shard = H.Shard(pd.DataFrame({"c1": c1, "c2": c2, "v": list(x), "vec_id": np.arange(4000), "key": np.arange(4000), "label": "a"}))
    radii = tuple(np.array([np.linalg.norm(part[c == k] - book[k], axis=1).max(initial=0) for k in range(len(book))])
                  for part, c, book in zip((x[:, :4], x[:, 4:]), (c1, c2), books))
    first, second = H.Cells(books, radii, {}).bounds(x[:1])
    seen, whole = [], shard.scores
    shard.scores = lambda a, b, q: seen.append(b - a) or whole(a, b, q)
    best = H.Best(6, -np.inf, np.inf)
    shard.search(x[0], "a", True, first[0], second[0], [best])
    truth = heapq.nlargest(6, ((int(s), -i) for i, s in enumerate(x @ x[0])))
    assert sorted(((s, i) for s, i, _ in best.items), reverse=True) == truth and sum(seen) < 2000


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(6, 6))
    rows = [(i, (centre[i % 6] + 0.3 * rng.normal(size=6)).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    hot = rows[0][1]
    rows += [(1000 + i, hot, 0 if i % 4 else 1) for i in range(150)]  # copies of an anchor, anchors among them
    rows += [(50, rows[50][1], rows[50][2])] * 2  # repeated rows
    rows += [(None, hot, 0), (2000, None, 0), (2050, hot, None), (2100, [float("nan")] * 6, 1), (2150, [None] * 6, 1), (2200, [float("inf")] * 6, 1),
             (2250, [1.0, 2.0], 1), (2251, [1.0, 2.0], 1), (2252, [1.0, 1.0], 2), (2300, [], 0), (2301, [], 0), (2302, [], 1)]
    return spark.createDataFrame(rows, SCHEMA), rows


@pytest.mark.parametrize("params", [{}, {"cell_rows": 8, "shard_rows": 64, "query_block": 4}, {"sample": 16, "codes": 2, "shard_rows": 100}])
def test_matches_brute_force(vectors, params):
    df, rows = vectors
    assert mined(df.repartition(3), **params) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [float(1 << 18), 3.0], 1), (1, [float(1 << 18), 5.0], 1), (2, [float(1 << 18) * 0.9, 1.0], 2), (3, [float(1 << 18) * 0.9, 2.0], 2)]
    got = sorted(tuple(r) for r in H.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 0, params=H.Params(scale=1 << 10)).collect())
    assert [r[-2:] for r in got] == [(r[-2], r[-1]) for r in brute(rows, 1 << 10) if r[0] == 0] and got


def test_empty_tables_no_anchors_and_clashing_names(spark, vectors):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    df, rows = vectors
    assert H.mine(df, F.lit(False)).collect() == []
    assert sorted(map(tuple, H.mine(clashing(df), F.col("vec_id") % 50 == 0).collect())) == brute(rows)
