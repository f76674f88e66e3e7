import random

import pytest

from conftest import clashing
from sigspark.llm.queries import op7_token_counts, piece_model
from sigspark.llm.token_counts import PrefixCounter, count_tokens

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    processor = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    return lambda text: len(processor.encode(text or ""))


@pytest.fixture(scope="module")
def counter():
    return PrefixCounter(piece_model())


PARTS = [" ", "  ", "a", "b", "e", "th", "ing", "\n", "\r\n", "\t", "▁", "<s>", "</s>", "<unk>", "é", "日本", "🙂", "\x00", "aaaa", "====", "def ",
         "return", "(", ");\r\n", "0", "123", ".", "ß", "http://", "able", "<0x0A>"]


def test_every_prefix_and_budget(library, counter):
    rng = random.Random(11)
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        table = counter.prefixes(text)
        counts = [library(text[:j]) for j in range(len(text) + 1)]
        assert [table.count(j) for j in range(len(text) + 1)] == counts
        for budget in (0, 1, 3, 6):
            assert table.truncate(budget) == max(j for j, c in enumerate(counts) if c <= budget)


def test_tables_fall_back_to_the_library(library, counter, monkeypatch):
    other = PrefixCounter(piece_model())
    monkeypatch.setattr(other, "_compute", lambda *a: False)
    assert [other.prefixes("strangest words").count(j) for j in range(16)] == [library("strangest words"[:j]) for j in range(16)]


def test_rows(spark, sf_dir, edge_docs, no_docs, library):
    for df in (edge_docs, clashing(edge_docs)):
        got = count_tokens(df, piece_model(), 100, "doc_id", "text").collect()
        want = [(r.doc_id, len((r.text or "").encode()), library(r.text), library(r.text) > 100) for r in df.collect()]
        assert sorted(((r.id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=repr) == sorted(want, key=repr)
    assert count_tokens(no_docs, piece_model(), 100).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in op7_token_counts(spark, sf_dir).collect():
        n = library(docs[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 4096)
        assert r.over_limit == (r.budget_chars < len(docs[r.doc_id]))
