"""Appends to stored tables: what is read, what is published, replays and repeats."""

import pytest
from pyspark.sql import functions as F

from sigspark.sources import keyed as K
from sigspark.sources import sinks as S

SCHEMA = "k string, n long, v double"


def rows(spark, lo, hi):
    return spark.range(lo, hi, numPartitions=4).select(F.concat(F.lit("k"), F.col("id") % 97).alias("k"), F.col("id").alias("n"),
                                                       (F.col("id") / 7).alias("v"))


def parts(spark, path):
    return {(r[0], r[1]) for r in spark.read.parquet(path).select(K.BATCH, K.PART).distinct().collect()}


@pytest.fixture(scope="module")
def million(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed") / "t")
    assert K.append_rows(rows(spark, 0, 1_000_000), path, ["k", "n"], part_rows=1 << 14) == 1_000_000
    return path


def test_a_thousand_new_keys_read_few_files_of_a_million(spark, million):
    assert len(parts(spark, million)) == 64
    batch = rows(spark, 2_000_000, 2_001_000)
    touched = K.touched_parts(batch, K.key_statistics(spark, million), ["k", "n"]).count()
    assert touched <= 3  # by chance: 1 of 5,000 probes
    batch = batch.unionByName(rows(spark, 77, 78))
    keys = K.stored_keys(batch, million, ["k", "n"])
    assert "PartitionFilters: [" in keys._jdf.queryExecution().executedPlan().toString()
    assert 1 <= keys.select(F.input_file_name()).distinct().count() <= 4
    assert keys.count() < 4 * 2 * (1 << 14)


def test_repeated_keys_are_always_found(spark, million):
    batch = rows(spark, 500, 560).unionByName(rows(spark, 3_000_000, 3_000_040))
    assert K.absent_rows(batch, million, ["k", "n"]).count() == 40
    stats = K.key_statistics(spark, million)
    everything = K.touched_parts(rows(spark, 0, 1_000_000), stats, ["k", "n"]).count()
    assert everything == 64  # no stored key is missed by any block's filter
    assert stats.agg(F.sum("keys")).first()[0] == 1_000_000


def test_later_batches_of_other_sizes_and_replays(spark, scratch):
    path = f"{scratch}/t"
    total = 0
    for lo, hi in ((0, 3), (2, 900), (0, 5000), (4000, 4100), (10, 5001)):
        got = K.append_rows(rows(spark, lo, hi), path, ["k", "n"], part_rows=256, block_keys=64)
        assert got == max(0, hi - total)
        total = max(total, hi)
        stored = K.stored_table(spark, path)
        assert stored.count() == total == stored.distinct().count()
    assert stored.columns == ["k", "n", "v"]
    assert K.key_statistics(spark, path).select("depth").distinct().count() > 2


def test_an_unpublished_batch_is_not_read_and_is_written_again(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    K.append_rows(rows(spark, 0, 50), path, ["k", "n"])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(K, "_write_statistics", lost)
        with pytest.raises(RuntimeError):
            K.append_rows(rows(spark, 0, 80), path, ["k", "n"])
    assert K.stored_table(spark, path).count() == 50
    assert K.append_rows(rows(spark, 0, 80), path, ["k", "n"]) == 30
    assert K.stored_table(spark, path).select("n").distinct().count() == K.stored_table(spark, path).count() == 80


def test_nulls_in_keys_a_hot_column_value_and_an_empty_batch(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(None, 1, 1.0), ("a", None, 2.0), (None, None, 3.0), (None, 1, 0.5)], SCHEMA)
    assert K.append_rows(df, path, ["k", "n"]) == 3
    assert K.append_rows(df, path, ["k", "n"]) == 0
    assert K.append_rows(df.limit(0), path, ["k", "n"]) == 0
    hot = spark.range(4096).select(F.lit("hot").alias("k"), F.col("id").alias("n"), F.lit(0.0).alias("v"))
    assert K.append_rows(hot, path, ["k", "n"], part_rows=512) == 4096
    sizes = [r[1] for r in spark.read.parquet(path).where("k = 'hot'").groupBy(K.BATCH, K.PART).count().select(K.PART, "count").collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_more_touched_parts_than_are_listed(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    K.append_rows(rows(spark, 0, 2000), path, ["k", "n"], part_rows=128)
    monkeypatch.setattr(K, "MAX_LISTED_PARTS", 3)
    assert K.append_rows(rows(spark, 0, 2010), path, ["k", "n"]) == 10


def test_signature_appends_keep_the_first_row_of_a_key(spark, scratch):
    df = spark.createDataFrame([("a", "s", "g", 3.0), ("a", "s", "g", 1.0)], "pert_iname string, sig_id string, pr_gene_symbol string, z_score double")
    assert S.append_new_signatures(df, f"{scratch}/t") == 1
    assert S.stored_table(spark, f"{scratch}/t").first()["z_score"] == 1.0
