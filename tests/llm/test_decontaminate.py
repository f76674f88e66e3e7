import random

from conftest import clashing
from sigspark.llm import decontaminate as dc
from sigspark.llm.queries import op2_decontamination

ITEM = "the capital of the old kingdom was moved three times before the river changed its course and the harbour fell dry"


def covered_by_definition(item, doc, m):
    """Greedy tiling with the longest run searched anew each time."""
    fi, fd, n_covered = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for t in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while t + n < len(item) and p + n < len(doc) and fi[t + n] and fd[p + n] and item[t + n] == doc[p + n]:
                    n += 1
                best = max(best, (n, -t, -p))
        n, t, p = best[0], -best[1], -best[2]
        if n < m:
            return n_covered
        n_covered += n
        fi[t:t + n], fd[p:p + n] = [False] * n, [False] * n


def test_tiles():
    rng, same = random.Random(3), 0
    for _ in range(300):
        a = [rng.randint(1, 5) for _ in range(rng.randint(1, 30))]
        b = [rng.randint(1, 5) for _ in range(rng.randint(1, 40))]
        tiles = dc.greedy_tiles(a, b, 3)
        assert all(n >= 3 and a[t:t + n] == b[p:p + n] for t, p, n in tiles)
        for k in (0, 1):
            spots = [x for tile in tiles for x in range(tile[k], tile[k] + tile[2])]
            assert len(spots) == len(set(spots))
        same += sum(n for *_, n in tiles) == covered_by_definition(a, b, 3)
    assert same >= 290  # equal but for the choice among equally long runs


def leaked(spark, docs, items, **params):
    d = clashing(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return sorted((r.id, r.item_id) for r in dc.leaks(d, b, "doc_id", "text", params=dc.Params(**params)).collect())


def test_leaks(spark):
    w = ITEM.split()
    reordered = " ".join(w[14:] + ["filler"] * 5 + w[7:14] + ["more"] + w[:7])
    shuffled = " ".join(random.Random(1).sample(w, len(w)))
    docs = [f"Some text. {ITEM.upper()}! And more.", reordered, shuffled, None, "", ITEM[: len(ITEM) // 2], "unrelated words only here",
            "“" + ITEM.replace(" ", ", ") + "”", (ITEM + " ") * 3000, ITEM, ITEM, " ".join(w[:9] + ["odd"] + w[10:])]
    items = [ITEM, None, "", "two words", ITEM]
    want = [(i, j) for i in (0, 1, 7, 8, 9, 10, 11) for j in (0, 4)]
    assert leaked(spark, docs, items) == want
    assert leaked(spark, docs, items, block_bytes=10) == want  # several blocks of items
    assert leaked(spark, docs, []) == [] and leaked(spark, [], items) == [] and leaked(spark, [None, ""], [None]) == []
    assert leaked(spark, ["these are two words of it"], ["two words"]) == [(0, 0)]  # an item below the least match is a seed as a whole


def test_one_block_at_a_time(spark, edge_docs, monkeypatch):
    """Each block is read after the results of the one before are landed; the
    results are those of one block, for text ids and repeated items too."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    items = [(f"item {i}", " ".join(rng.choices(words, k=rng.randint(3, 30)))) for i in range(12)]
    items += items[:3] + [(None, items[4][1])]
    docs = [(i, " ".join(t for _, t in rng.sample(items, 2)) if i % 3 else " ".join(rng.choices(words, k=50))) for i in range(30)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    want = sorted(((i, k) for i, t in docs for k, x in items
                   if covered_by_definition(x.split(), t.split(), min(4, len(x.split()))) >= 0.7 * len(x.split())), key=repr)
    steps, land, seeds = [], dc.land, dc.Seeds.__init__
    monkeypatch.setattr(dc, "land", lambda df, name: (steps.append(name), land(df, name))[1])
    monkeypatch.setattr(dc.Seeds, "__init__", lambda self, ids, *a: (steps.append(len(ids)), seeds(self, ids, *a))[1])
    for size in (1 << 20, 300):
        steps.clear()
        params = dc.Params(block_bytes=size)
        assert sorted(((r.id, r.item_id) for r in dc.leaks(d, b, params=params).collect()), key=repr) == want
        assert [x for x in steps if x == "leaks"] == ["leaks"] * (sum(isinstance(x, int) for x in steps) - 1)
        assert all(not isinstance(x, int) or not isinstance(y, int) for x, y in zip(steps, steps[1:]))
        left = sorted(r.doc_id for r in dc.drop_leaks(d, b, params=params).collect())
        assert left == [i for i, _ in docs if i not in {x for x, _ in want}]
        marked = dc.with_leaks(d, b, "m", params=params).collect()
        assert sorted(((r.doc_id, m.item_id) for r in marked for m in r.m), key=repr) == want
    assert sum(isinstance(x, int) for x in steps) > 3 * 2


def test_drop_keeps_columns(spark, edge_docs):
    b = spark.createDataFrame([(1, "other text with id two")], "item_id long, text string")
    got = dc.drop_leaks(clashing(edge_docs), b)
    assert got.columns == clashing(edge_docs).columns and got.count() == edge_docs.count() - 1


def test_query_finds_every_verbatim_item(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    got = op2_decontamination(spark, sf_dir).collect()
    assert {(d, i) for d, t in docs.items() for i, x in items.items() if x in t} <= {(r.doc_id, r.item_id) for r in got}
    assert all(0.7 <= r.coverage <= 1 for r in got)
