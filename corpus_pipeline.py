"""The corpus pipeline: documents in, a mixed training corpus out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame with the columns of documents (the last one adds the
mix), which is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm import decontaminate, language_id, mixing, simhash, substring_dedup
from sigspark.llm.common import bitmap_test, fresh, hash_bitmap, land, ship, table
from sigspark.session import scratch_root

DOUBT_BITS = 24


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language ID rejects (no letter, or too far from
    every language); the model is learned from the labelled rows among docs."""
    ship(spark)
    model = language_id.fit_on_training_rows(docs)
    names = [fresh(docs, n) for n in ("lang_pred", "score", "rejected")]
    return language_id.predict(docs, model, "text", *names).filter(~F.col(names[2])).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component: that with the least id
    (null ids last), of several texts with that id the one with the least hash,
    of equal rows one."""
    ship(spark)
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    marked = land(simhash.near_duplicates(docs.select(key.alias("key"), "text"), "key", "text"), "near-duplicates")
    keep = marked.filter(F.col("id") == F.col("component")).select(F.col("id").alias("key")).distinct()
    # Only documents of components with several rows are in doubt. A bitmap of
    # bounded size knows them (and a few others), so other texts are not shuffled.
    several = land(marked.groupBy("component").count().filter("count > 1").select("component"), "components-of-several")
    doubted = marked.join(several, "component", "left_semi").select(F.xxhash64("id").alias("h"))
    out = docs.withColumn(name := fresh(docs, "nd_key"), key)
    test = bitmap_test(spark.sparkContext.broadcast(hash_bitmap(doubted, "h", DOUBT_BITS)))(F.xxhash64(out[name]))
    chosen = out.filter(test).join(keep, out[name] == keep["key"], "left_semi").dropDuplicates([name])
    return out.filter(~test).unionByName(chosen).drop(name)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes words covered by 50-word windows that an earlier document also
    has. A text that loses words becomes its other words joined by one space."""
    ship(spark)
    names = [fresh(docs, n) for n in ("kept", "n_removed", "n_words")]
    out = substring_dedup.dedup_substrings(docs, kept_out=names[0], removed_out=names[1], words_out=names[2])
    cut = F.col(names[1]) > 0
    return out.withColumns({"text": F.when(cut, F.col(names[0])).otherwise(F.col("text")),
                            "n_chars": F.when(cut, F.length(names[0]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))}
                           ).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents into which a benchmark item leaks."""
    ship(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the words that the mix takes of each."""
    ship(spark)
    names = [fresh(docs, n) for n in ("size", "source_size", "target", "taken")]
    return mixing.mix(docs, size_out=names[0], source_size_out=names[1], target_out=names[2], taken_out=names[3])


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]

# Language ID learns its centroids and tiling is iterative: no SQL statement gives run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    root = f"{scratch_root(spark)}/llm/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{name}")
    return docs
