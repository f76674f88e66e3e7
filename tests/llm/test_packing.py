import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sigspark.llm import packing as P
from tests.llm.conftest import SCHEMA, clashing

FILE = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    tokenizer = Tokenizer.from_file(FILE)
    return [np.array([*e.ids, 1], "<u4") for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, docs, window=2048):
    """Each token lies in one piece; sequences have no gap and need no padding."""
    ids = {}
    for (doc_id, text), x in zip(docs, library([t for _, t in docs])):
        ids.setdefault(doc_id, []).append(x)
    found = {}
    for r in rows:
        found.setdefault((r["part"], r["row"], r["id"]), []).append(r)
    whole = {}
    for (_, _, doc_id), pieces in found.items():
        pieces.sort(key=lambda r: r["start"])
        n = pieces[0]["n_tokens"]
        assert [r["start"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist() and sum(r["length"] for r in pieces) == n
        twin = [x for x in ids[doc_id] if len(x) == n and all(zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in pieces)]
        assert twin
        whole[doc_id] = whole.get(doc_id, 0) + 1
    assert whole == {k: len(v) for k, v in ids.items()}
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        pieces.sort()
        total = sum(n for _, n in pieces)
        assert [o for o, _ in pieces] == np.cumsum([0, *(n for _, n in pieces)])[:-1].tolist()
        assert total <= window and total & (total - 1) == 0


def packed(df, **kw):
    params = P.Params(**kw)
    return [r.asDict() for r in P.pack(P.tokenize(df, FILE, params=params), params).collect()]


def test_encoder_gives_the_library_s_ids():
    texts = ["", " ", "  two  blanks ", "tab\t\tand\n\n line\r\n ends \n", "don't we'll  x", "nbsp\xa0\xa0 here 　wide 日本語 テキスト", "<|endoftext|> in text",
             "a <|endoftext|>", "\x1c\x1d odd \x0b\x0c blanks \x85   x", "x" * 3000, "ÀÉ 🙂🙂  🙂", "  \n", " lead", "12 345\n\n\n  6"]
    texts += ["x" * 100_000, "a" + " " * 50_000 + "b", " \n" * 40_000, "日" * 30_000]
    encoder = P.Encoder(FILE)
    assert [encoder.encode(t) + b"\x01\0\0\0" for t in texts] == [x.tobytes() for x in library(texts)] and encoder._ranked


def test_other_files_go_to_their_library():
    tokenizer, encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), P.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    text = "Some  words, and MORE\n words"
    assert encoder._ranked is None and encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_encoder_on_random_blanks():
    rng = np.random.default_rng(1)
    letters = list("ab1'.é日 \t\n\xa0 \x0b\x1c\x85s")
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(3000)]
    encoder = P.Encoder(FILE)
    assert [encoder.encode(t) + b"\x01\0\0\0" for t in texts] == [x.tobytes() for x in library(texts)]


@pytest.mark.parametrize("window", [2048, 64, 8])
def test_every_token_in_one_piece(spark, edge_docs, window):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    check(packed(edge_docs.repartition(3), window=window), docs, window)


def test_many_lengths_over_many_partitions(spark):
    rng = np.random.default_rng(2)
    docs = [(i, " ".join(["word"] * int(n))) for i, n in enumerate(rng.integers(0, 300, 900))]
    docs += [(1000 + i, "word " * 40) for i in range(450)]  # one length holds a third
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = packed(df, window=256)
    check(rows, docs, 256)
    cut = len({(r["part"], r["row"]) for r in rows if r["length"] < r["n_tokens"] and r["n_tokens"] < 256})
    assert cut < 0.2 * len(docs)


def test_plan_gives_every_rank_a_place():
    rng = np.random.default_rng(3)
    for shape in (rng.integers(0, 30, 128), rng.integers(0, 2, 128), np.eye(1, 128, 1, dtype=int)[0] * 1000, np.eye(1, 128, 64, dtype=int)[0] * 5,
                  np.zeros(128, int), np.eye(1, 128, 127, dtype=int)[0] * 77):
        plan = P.plan_tails(shape, P.Params(window=128))
        shape = shape.copy()
        shape[0] = 0
        tail = np.repeat(np.arange(128), shape)
        rank = np.concatenate([np.arange(n) for n in shape]) if shape.sum() else np.zeros(0, int)
        fill = {}
        for n, pieces in zip(tail.tolist(), P.place_tails(plan, tail, rank.astype(np.int64))):
            assert sum(p[0] for p in pieces) == n
            for size, s, o in pieces:
                fill.setdefault(s, []).append((o, size))
        for cells in fill.values():
            cells.sort()
            ends = np.cumsum([n for _, n in cells])
            assert [o for o, _ in cells] == [0, *ends[:-1].tolist()] and ends[-1] in (1, 2, 4, 8, 16, 32, 64, 128)
        assert sorted(fill) == list(range(plan.sequences))


def test_least_squares_meets_a_histogram_that_combinations_can_use_up():
    columns = np.array([[0, 3, 5], [2, 3, 3], [0, 4, 4]])
    counts = np.bincount(columns[:, 0], [0, 7, 0], 8) + np.bincount(columns[:, 1], [9, 7, 4], 8) + np.bincount(columns[:, 2], [9, 7, 4], 8)
    x = P.least_squares(columns, np.ones_like(columns), counts, 2000)
    assert np.allclose(x, [9, 7, 4], atol=0.05) and (x >= 0).all()


def test_sequences_hold_the_ids(spark, edge_docs):
    tokens = P.tokenize(edge_docs, FILE, keep_ids=True)
    pieces = P.pack(tokens)
    rows = {r["sequence_id"]: bytes(r["ids"]) for r in P.sequences(tokens, pieces).collect()}
    for r in pieces.collect():
        assert zlib.crc32(rows[r["sequence_id"]][4 * r["offset"]:4 * (r["offset"] + r["length"])]) == r["ids_crc32"]


def test_empty_table_and_clashing_names(spark, no_docs, edge_docs):
    assert packed(no_docs) == []
    assert len(packed(clashing(edge_docs))) == len(packed(edge_docs))
    assert SCHEMA.startswith("doc_id")
