import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SCHEMA, clashing
from sigspark.llm import mixing, topk

VECTORS = "vec_id long, embedding array<float>, label int"


def by_definition(rows, k):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def found(df, **params):
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, params=topk.Params(**params)).collect())


def test_topk_against_all_pairs(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], 1) for i in range(700)]
    rows += [(i, [0.5] * 6, 1) for i in range(700, 900)]  # ties
    rows += [(100, [1.0, 2.0], 1), (901, [3.0, 4.0], 1), (902, None, 1), (903, [1.0, None], 1), (904, [float("nan")] * 6, 1), (905, [float("inf")] * 6, 1),
             (None, [9.0] * 6, 1), (200, [0.1] * 6, 1), (200, [0.1] * 6, 1), (1000, [], 1), (1001, [], 1)]
    df = clashing(spark.createDataFrame(rows, VECTORS))
    want = by_definition(rows, 10)
    assert found(df) == want
    assert found(df, shard_rows=64, query_block=4, leaf=8) == want
    assert found(df, shard_rows=300, k=1) == by_definition(rows, 1)
    assert found(df.limit(0)) == [] and found(df.filter("vec_id = 1")) == []


def test_tree_prunes_and_stays_exact():
    rng = np.random.default_rng(4)
    points = rng.integers(-1000, 1000, (4000, 3))
    tree = topk.KDTree(points, np.arange(4000), 16)
    assert all((tree.points[a:b] >= lo).all() and (tree.points[a:b] <= hi).all() for (a, b), lo, hi in zip(tree.span, tree.low, tree.high))
    q = rng.integers(-1000, 1000, (5, 3))
    bounds = tree.bounds(q)
    for i in range(5):
        got = tree.search(q[i], bounds[i], -1, np.arange(4000), 10, topk.NO_FLOOR)
        assert [s for s, _ in got] == sorted((points @ q[i]).tolist(), reverse=True)[:10]


def test_large_components_give_exact_scores(spark):
    """Components of the queries, too, decide whether doubles are exact."""
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-2000, 2000)) for _ in range(4)], 1) for i in range(1, 400)]
    rows += [(100 * i, [float((1 << 50) + 3 * i), 1.0, 7.0, -3.0], 1) for i in (50, 60)]
    rows += [(10_000 + i, [2000.0, float(i % 3), 1.0, 0.0], 1) for i in range(1, 40)]  # near ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ok = [(i, [int(x) for x in v]) for i, v, _ in rows]
    for size in (8192, 64):
        got = topk.top_k(df.repartition(3), F.col("vec_id").isin(5000, 6000), params=topk.Params(scale=1, shard_rows=size, leaf=8)).collect()
        for q in (5000, 6000):
            own = dict(ok)[q]
            dot = sorted((-sum(x * y for x, y in zip(own, v)), j) for j, v in ok if j not in (5000, 6000))[:10]
            mine = sorted((-r["score"], r["vec_id"]) for r in got if r["query_id"] == q and r["vec_id"] not in (5000, 6000))
            assert mine == dot[:len(mine)] and len(mine) >= 8


def test_water_fill(spark):
    sizes = [("a", 10), ("b", 100), ("c", 1000), ("d", 5), ("e", 0), (None, 300)]
    got = {r.source: r for r in mixing.water_fill(spark.createDataFrame(sizes, "source string, size long")).collect()}
    assert [got[s].weight for s in ("a", "b", "c", "d", "e", None)] == [5, 2, 1, 5, 2, 1]
    total = sum(n for _, n in sizes)
    assert sum(r.target for r in got.values()) == pytest.approx(1.5 * total)
    assert all(got[s].target <= 2 * n for s, n in sizes)
    free = [(got[s].target / got[s].weight) for s, n in sizes if got[s].target < 2 * n]
    assert max(free) == pytest.approx(min(free)) and all(got[s].target / got[s].weight <= min(free) + 1e-9 for s, n in sizes)


def check_mix(df, got):
    assert len(got) == df.count()
    by = {}
    for r in got:
        assert r.size == len((r.text or "").encode().split()) and 0 <= r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        assert rows[0].source_size == sum(r.size for r in rows)
        assert abs(sum(r.taken for r in rows) - rows[0].target) < 1 + len(rows)


def test_mix(spark, sf_dir, edge_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = mixing.mix(docs).collect()
    check_mix(docs, got)
    per = {}
    for r in got:
        per.setdefault(r.source, [r.target, 0])[1] += r.taken
    assert all(0 <= t - n < 1 for t, n in per.values())  # to the word
    again = {r.doc_id: r.taken for r in mixing.mix(docs.repartition(5)).collect()}
    assert again == {r.doc_id: r.taken for r in got}
    other = {r.doc_id: r.taken for r in mixing.mix(docs, params=replace(mixing.Params(), seed=1)).collect()}
    assert other != again
    for df in (edge_docs, clashing(edge_docs).drop("size")):
        check_mix(df, mixing.mix(df).collect())
    assert mixing.mix(no_docs).count() == 0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as cp

    assert [n for n, _ in cp.STAGES] == ["language_id", "simhash_near_dedup", "substring_dedup", "decontamination", "mixing"]
    passage = "the capital of the old kingdom was moved three times before the river changed its course and the harbour fell dry"
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(100_000, "12 34", "en", "a", 5), (100_001, None, None, None, None), (100_002, passage, "en", "a", 1), (100_002, passage, "en", "a", 1),
             (100_003, passage.upper(), "en", "b", 1), (100_004, "some words around " + item + " and some more", "en", "b", 1), (None, passage, "en", "b", 1)]
    docs = base.select(*SCHEMA_COLUMNS).union(spark.createDataFrame(extra, SCHEMA).select(*SCHEMA_COLUMNS)).withColumn("extra", F.lit(1))
    kept = {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "mixing":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = sorted((r.doc_id is None, r.doc_id or 0) for r in docs.collect())
    at = lambda stage: [i for none, i in kept[stage] if not none and i >= 100_000]
    assert at("language_id") == [100_002, 100_002, 100_003, 100_004] and at("simhash_near_dedup") == [100_002, 100_004]
    assert (True, 0) in kept["language_id"] and (True, 0) not in kept["simhash_near_dedup"]
    assert at("substring_dedup") == [100_002, 100_004] and at("decontamination") == [100_002] == at("mixing")
    assert docs.columns[-4:] == ["size", "source_size", "target", "taken"]


SCHEMA_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def test_pipeline_on_an_empty_table(spark, sf_dir, no_docs):
    import corpus_pipeline as cp

    docs = no_docs
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0


def test_run(spark, sf_dir):
    import corpus_pipeline as cp

    out = cp.run(spark, sf_dir)
    assert 0 < out.count() <= spark.read.parquet(f"{sf_dir}/documents.parquet").count() and out.select("doc_id").distinct().count() == out.count()
