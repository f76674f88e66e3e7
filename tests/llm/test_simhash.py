import random

import numpy as np
import xxhash

from conftest import clashing
from sigspark.llm.components import connected_components
from sigspark.llm.queries import op4_simhash
from sigspark.llm.simhash import GolayAnchors, anchors, fingerprint, links, near_duplicates


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
             .replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(pairs):
    """Least id reachable over fingerprints that differ in two bits or fewer."""
    fps = [f for _, f in pairs]
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, f, least.get(root(i))) for i, (doc, f) in enumerate(pairs)), key=repr)


def test_fingerprint():
    for text in (None, "", " \n", "a", "A b", "one two three", "One TWO three four", "Ü É x y z w", "a b c " * 100, "x" * 5000, " ".join(f"w{i % 901}" for i in range(70_000))):
        assert fingerprint(text.encode() if text else None) == plain_fingerprint(text)


def test_golay_code_is_perfect():
    code = GolayAnchors(0)
    assert np.array_equal(np.diff(code.first), np.ones(2048, int))  # one pattern of weight 3 or less per syndrome


def test_anchors_cover_all_neighbours():
    rng = random.Random(5)
    code, home = GolayAnchors(2), GolayAnchors(0)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 2)):
            y ^= 1 << b
        at_home = anchors(np.array([x], np.uint64).view(np.int64), home, 0)[1]
        visited = anchors(np.array([y], np.uint64).view(np.int64), code, 2)[1]
        assert len(at_home) == 1 and at_home[0] in visited and len(set(visited.tolist())) == len(visited)


def test_links_are_all_close_pairs(spark):
    rng = random.Random(8)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    near = set(seeds)
    for s in seeds:
        for _ in range(8):
            near.add(s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = np.array(sorted(near), np.uint64).view(np.int64).tolist()
    got = {tuple(r) for r in links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    low = (1 << 64) - 1
    assert got == {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & low).bit_count() <= 2}


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 10), (3, 2), (10, 9), (50, 3), (5, 5), (None, 4)] + [(i, i + 1) for i in range(100, 140)]
    got = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{n: 1 for n in (1, 2, 3, 50)}, 9: 9, 10: 9, **{n: 100 for n in range(100, 141)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_on_edge_rows(spark, edge_docs, no_docs):
    want = classes([(r.doc_id, plain_fingerprint(r.text)) for r in edge_docs.collect()])
    low = (1 << 64) - 1
    for df in (edge_docs, clashing(edge_docs)):
        got = near_duplicates(df, "doc_id", "text").collect()
        assert sorted(((r.id, r.fp & low, r.component) for r in got), key=repr) == want
    assert near_duplicates(no_docs).count() == 0


def test_query(spark, sf_dir):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = op4_simhash(spark, sf_dir).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=repr) == classes(rows)
    assert all(len(r.fingerprint) == 16 for r in got)
