import pytest

from sigspark.llm.common import ship


@pytest.fixture(scope="session")
def spark(spark):
    ship(spark)
    return spark


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids, null, empty, blank and very long texts, repeated rows and ids."""
    para = " ".join(f"word{i % 97}x{i % 13}" for i in range(70))
    long = " ".join(f"w{i * 7919 % 4001}" for i in range(60_000))
    rows = [(1, para, "en", "a", 1), (2, "before it " + para + " and after", "en", "a", 1), (2, "other text with id two", "en", None, 1),
            (3, para, "en", "b", 1), (3, para, "en", "b", 1), (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \n\t ", "de", "c", 4),
            (None, para, "en", "a", 1), (None, None, None, None, None), (7, long, "en", "b", 1), (8, long + " end", "en", "b", 1),
            (9, "one", "en", "c", 3), (10, "x " * 500, "en", "c", 1), (11, "x " * 500, "en", "c", 1), (12, "ÀÉ 日本 🙂", "fr", "é", 9)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


CLASH = ["id", "fp", "component", "key", "v", "t", "h", "size", "node", "score", "m", "raw", "body", "sha", "rank", "dim", "shard", "block",
         "is_query", "_mx_size", "_sd_words", "taken_", "source_size_", "kept_", "leaks", "nd_key", "lang_pred", "rejected"]


def clashing(df):
    """The frame with extra columns under names that the operators use inside."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit("extra").alias(c) for c in CLASH if c not in df.columns))
