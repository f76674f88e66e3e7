import hashlib
import random
import zlib

import numpy as np

from sigspark.llm import periodic_runs as R
from sigspark.llm.queries import op13_periodic_runs
from tests.llm.conftest import clashing


def brute(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = q
        while i < len(w):
            j = i
            while j < len(w) and w[j] == w[j - q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def words_of(rng):
    n, kind, out = rng.randint(0, 150), rng.random(), []
    if kind < 0.3:
        return [rng.randint(0, rng.choice([0, 1, 2])) for _ in range(n)]
    if kind < 0.5:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    while len(out) < n:
        unit = [rng.randint(0, 2) for _ in range(rng.randint(1, 40))]
        unit = (unit * 10)[:rng.randint(1, 50)] if rng.random() < 0.5 else unit
        out += (unit * 4)[:int(len(unit) * rng.choice([1, 2, 2.3, 3, 3.5]))] + [9] * rng.randint(0, 1)
    return out


def test_runs_match_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        w = words_of(rng)
        for least in (12, 4):
            assert R.find_runs(np.array(w, dtype=np.int64), least) == brute(w, least), w


def test_a_run_whose_half_is_itself_periodic():
    unit = [0, 0, 1] * 5 + [0, 0]
    assert (1, 34, 17) in R.find_runs(np.array([5, *unit, *unit, 6]))


def test_least_lengths():
    assert R.find_runs(np.zeros(11, int)) == [] and R.find_runs(np.zeros(12, int)) == [(0, 12, 1)]
    assert R.find_runs(np.array([*range(6), *range(6)])) == [(0, 12, 6)]
    assert R.find_runs(np.array([*range(7), *range(6)])) == [] and R.find_runs(np.array([*range(40), *range(40)])) == [(0, 80, 40)]


def test_very_long_texts():
    assert R.find_runs(np.zeros(200_000, int)) == [(0, 200_000, 1)]
    line = np.concatenate([np.r_[np.arange(20), 100 + np.arange(1 + i % 37) + 1000 * i] for i in range(4000)])
    assert R.find_runs(line) == []


def row(text, doc_id=None, plant=False):
    w = (text or "").encode().split()
    if plant and doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
    runs = brute(w)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    return len(w), runs, b" ".join(x for i, x in enumerate(w) if i not in drop).decode()


def test_operator_on_edge_cases(spark, edge_docs, no_docs):
    extra = spark.createDataFrame([(20, "a b c d " * 5 + "e", None, None, None), (21, "x" * 40 + " ", None, None, None), (22, "a\x1cb\xa0c " * 12, None, None, None)],
                                  edge_docs.schema)
    docs = edge_docs.unionByName(extra).filter("doc_id is null or doc_id not in (7, 8)")
    got = [(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in R.periodic_runs(clashing(docs)).collect()]
    want = [(r["doc_id"], *row(r["text"])) for r in docs.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    long = R.periodic_runs(edge_docs.filter("doc_id in (7, 8)")).collect()
    assert [r["n_words"] for r in long] == [60_000, 60_001] and all(r["runs"] for r in long)
    assert R.periodic_runs(no_docs).collect() == []


def test_planted_repeats(spark, edge_docs, no_docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 60))), None, None, None) for i in range(120)] + [(30, "  ", None, None, None)] * 2
    docs = spark.createDataFrame(rows, edge_docs.schema).unionByName(edge_docs.filter("doc_id is null"))
    got = [(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in R.periodic_runs(R.plant_repeats(clashing(docs))).collect()]
    assert sorted(got, key=str) == sorted([(r["doc_id"], *row(r["text"], r["doc_id"], True)) for r in docs.collect()], key=str)
    assert R.plant_repeats(no_docs).collect() == [] and R.plant_repeats(clashing(docs)).columns == clashing(docs).columns


def test_query_against_brute_force(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r for r in op13_periodic_runs(spark, sf_dir).collect()}
    assert got.keys() == docs.keys()
    for doc_id, text in docs.items():
        if len(text or "") > 6000:
            continue
        _, runs, collapsed = row(text, doc_id, True)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        r = got[doc_id]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed.encode()).hexdigest()
