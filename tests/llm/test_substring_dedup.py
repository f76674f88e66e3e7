import hashlib
from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from conftest import clashing
from sigspark.llm import substring_dedup as sd
from sigspark.llm.common import flat


def brute(rows, k=50):
    """(words, removed, sha) per row, by a dictionary of all windows."""
    first = {}
    for doc, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - k + 1) if doc is not None else ():
            key = b" ".join(w[i:i + k])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - k + 1) if doc is not None else ():
            if first[b" ".join(w[i:i + k])] < doc:
                gone[i:i + k] = [True] * k
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, params=sd.Params()):
    out = sd.dedup_substrings(df, params=params, removed_out="gone")
    rows = out.select("doc_id", "n_words", "gone", F.sha2("kept", 256)).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_against_brute_force(spark, sf_dir, edge_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert found(docs) == want
    assert found(docs, replace(sd.Params(), group_limit=3, filter_bits=12)) == want  # hot groups, a full bitmap
    assert found(docs, replace(sd.Params(), group_limit=40, hot_bits=6)) == want  # a full bitmap of hot groups
    assert found(docs.repartition(7)) == want
    want = brute([(r.doc_id, r.text) for r in edge_docs.collect()])
    assert found(edge_docs) == want and found(clashing(edge_docs)) == want
    assert found(edge_docs, replace(sd.Params(), group_limit=1)) == want
    assert found(no_docs) == []


def test_small_windows(spark):
    texts = ["a b c d e f g", "x a b c d y", "a a a a a a a a", "a a a a", None, "d e f g a b c d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for k in (2, 3, 4):
        assert found(df, replace(sd.Params(), window=k, gram=2)) == brute(list(enumerate(texts)), k)


def test_super_kmers_cover_every_window():
    import pyarrow as pa

    texts = [b"a b c d e f g h i j k l m", b"", b"p q", b" z " * 40]
    p = sd.Params(window=5, gram=2)
    raw, at = flat(pa.array(texts))
    r, w, n, v, a, b = sd.super_kmers(raw, at, p)
    got = sorted((int(i), int(s) + j) for i, s, m in zip(r, w, n) for j in range(m))
    assert got == [(i, j) for i, t in enumerate(texts) for j in range(len(t.split()) - 4)]
    assert n.max() <= p.window - p.gram + 1
    for i, s, m, x, y in zip(r, w, n, a, b):
        assert raw[x:y].tobytes().split() == texts[i].split()[s:s + m + 4]


def test_equal_hashes_of_unequal_windows_are_told_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(sd, "word_hashes", lambda raw, start, end: np.zeros(len(start), np.uint64))
    rows = pa.array([b"a b c", b"a b d", b"a b c", b"a b d e"], pa.binary())
    sk, j = sd._sorted_windows(np.array([1, 2, 3, 4]), rows, 3)
    assert list(zip(sk.tolist(), j.tolist())) == [(2, 0), (3, 0)]
