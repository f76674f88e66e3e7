"""Stored tables that only grow, with key statistics (A8–A10 core).

Every append is a batch folder, cut into parts by the leading bits of the key
hash, so a part is one file of about ``PART_ROWS`` keys and no key value, however
frequent in one column, gathers in one of them. Beside the data lie statistics
of the keys, one row per block of about ``BLOCK_KEYS`` keys: the least and the
greatest hash and a Bloom filter of four bitmaps (Spark's bitmap aggregates).

The anti join of a later batch looks up its keys' blocks first (an equality
join on the hash prefix), and then reads only the parts in which a key may lie.
A new key passes a block's filter by chance in about 1 of 5,000 cases; that
costs a part read, never a wrong row.

A batch counts as stored once its statistics are published, which is the last
step. What a failed append leaves behind is not read, and the replayed batch is
written anew.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.operators.reshape import dedupe
from sigspark.operators.sides import joined

BATCH, PART, STATS = "_batch", "_part", "_key_stats"
PART_ROWS = 1 << 18
BLOCK_KEYS = 1 << 12
MAX_PART_DEPTH = 12   # 4,096 parts a batch: larger batches have larger files
MAX_LISTED_PARTS = 4096  # parts named in a filter; beyond, all batches are read
_BITS = 1 << 15  # of one bitmap: Spark's bitmap aggregates have this size
_SLICE = 64  # bytes; a bitmap is stored in slices, so that a test copies one and not the bitmap
_FILTERS = range(4)


def _depth(rows: int, per_cell: int, most: int = 40) -> int:
    return min(most, max(0, (max(1, -(-rows // per_cell)) - 1).bit_length()))


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _prefix(hashed: Column, depth: int | Column) -> Column:
    """The leading ``depth`` bits as a number."""
    if isinstance(depth, int):
        return F.shiftrightunsigned(hashed, 64 - depth) if depth else F.lit(0).cast("long")
    return F.when(depth == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftrightunsigned", hashed, 64 - depth))


def _bit(keys: Sequence[str], i: int) -> Column:
    """The key's bit in the i-th bitmap of its block."""
    return F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(_BITS))


def _slices(bitmap: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(_BITS // 8 // _SLICE - 1)),
                       lambda i: F.substring(bitmap, i * F.lit(_SLICE) + F.lit(1), F.lit(_SLICE)))


def _holds(slices: Column, bit: Column) -> Column:
    byte = F.floor(bit / 8).cast("int")
    one = F.substring(F.get(slices, F.floor(byte / _SLICE).cast("int")), byte % _SLICE + 1, F.lit(1))
    return F.call_function("getbit", F.conv(F.hex(one), 16, 10).cast("int"), (bit % 8).cast("int")) == 1


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def key_statistics(spark: SparkSession, path: str) -> DataFrame | None:
    """Rows (depth, block, part, lo, hi, keys, b0..b3, _batch); None when nothing is stored yet."""
    return _read(spark, f"{path}/{STATS}")


def _published(data: DataFrame, stats: DataFrame) -> DataFrame:
    batches = stats.select(BATCH).distinct()  # one row per append
    return data.join(F.broadcast(batches), BATCH, "left_semi")


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored rows without the storage columns; None when nothing is stored yet."""
    stats = key_statistics(spark, path)
    data = None if stats is None else _read(spark, path)
    return None if data is None else _published(data, stats).drop(BATCH, PART)


def touched_parts(batch: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(_batch, _part) of the parts in which a key of ``batch`` may lie.

    A key's block has a number for each depth in use (at most 41 numbers reach
    the driver); the block is found by equality on depth and number."""
    depths = [r["depth"] for r in stats.select("depth").distinct().collect()]
    hashed = batch.select(*keys, _hash(keys).alias("__h"))
    blocks = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(F.col("__h"), d).alias("block")) for d in depths])
    probes = hashed.select("__h", *[_bit(keys, i).alias(f"__p{i}") for i in _FILTERS], F.explode(blocks).alias("__b")).select(
        "__h", *[f"__p{i}" for i in _FILTERS], "__b.*")
    found = probes.join(stats, ["depth", "block"], "inner").where(F.col("__h").between(F.col("lo"), F.col("hi")))
    found = found.where(reduce(lambda a, b: a & b, [_holds(F.col(f"b{i}"), F.col(f"__p{i}")) for i in _FILTERS]))
    return found.select(BATCH, F.col("part").alias(PART)).distinct()


def stored_keys(batch: DataFrame, path: str, keys: Sequence[str]) -> DataFrame | None:
    """Stored keys that ``batch`` may repeat, read from the touched parts only.

    At most ``MAX_LISTED_PARTS`` part names reach the driver and become a
    partition filter; when more are touched all published batches are read."""
    spark = batch.sparkSession
    stats = key_statistics(spark, path)
    data = None if stats is None else _read(spark, path)
    if data is None:
        return None
    parts = touched_parts(batch, stats, keys).limit(MAX_LISTED_PARTS + 1).collect()
    if len(parts) > MAX_LISTED_PARTS:
        return _published(data, stats).select(*keys)
    wanted: dict[int, list[str]] = {}
    for r in parts:
        wanted.setdefault(r[PART], []).append(r[BATCH])
    here = [(F.col(PART) == p) & F.col(BATCH).isin(batches) for p, batches in sorted(wanted.items())]
    return data.where(reduce(lambda a, b: a | b, here, F.lit(False))).select(*keys)


def absent_rows(new: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet (lazy).

    Of the rows that repeat a key in the batch the first by the other columns'
    values is kept (the reference dropped the whole batch), so reruns agree.
    Keys match with their nulls, so a replayed null key is no new one."""
    keys = list(keys)
    others = [c for c in new.columns if c not in keys]
    batch = dedupe(new, keys, others or keys, keep="first")
    stored = stored_keys(new, path, keys)  # of the rows as they came: the same keys, without another dedupe
    if stored is None:
        return batch
    stored = stored.select(*[F.col(k).alias(f"__s_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]
    return joined(batch, stored, reduce(lambda a, b: a & b, same), "left_anti")


def _write_statistics(spark: SparkSession, path: str, batch: str, keys: Sequence[str], depth: int) -> int:
    """Publish the batch: its statistics, from the key columns of its own files. Returns its rows."""
    written = _read(spark, f"{path}/{BATCH}={batch}")
    if written is None:  # nothing was new
        return 0
    rows = written.select(PART, *keys).withColumn("__h", _hash(keys)).withColumn("block", _prefix(F.col("__h"), depth))
    bits = [F.call_function("bitmap_construct_agg", F.call_function("bitmap_bit_position", _bit(keys, i) + 1)).alias(f"b{i}")
            for i in _FILTERS]
    stats = rows.groupBy("block", F.col(PART).cast("int").alias("part")).agg(
        F.min("__h").alias("lo"), F.max("__h").alias("hi"), F.count(F.lit(1)).alias("keys"), *bits)
    where = f"{path}/{STATS}/{BATCH}={batch}"
    plain = [c for c in stats.columns if c not in {f"b{i}" for i in _FILTERS}]
    stats = stats.select(F.lit(depth).alias("depth"), *plain, *[_slices(F.col(f"b{i}")).alias(f"b{i}") for i in _FILTERS])
    stats.sortWithinPartitions("block").write.mode("overwrite").parquet(where)
    return spark.read.parquet(where).agg(F.sum("keys")).first()[0] or 0


def append_rows(new: DataFrame, path: str, keys: Sequence[str], rows: int | None = None,
                part_rows: int = PART_ROWS, block_keys: int = BLOCK_KEYS) -> int:
    """Append the rows of ``new`` whose key is not stored; returns how many.

    ``rows`` is the size of the batch if the caller knows it. One job finds the
    touched parts, one writes, one publishes; the stored table is never counted."""
    spark, keys = new.sparkSession, list(keys)
    rows = new.count() if rows is None else rows
    if not rows:
        return 0
    batch, parts = f"b{uuid.uuid4().hex[:16]}", _depth(rows, part_rows, MAX_PART_DEPTH)
    fresh = absent_rows(new, path, keys).withColumn(PART, _prefix(_hash(keys), parts).cast("int"))
    if parts:
        fresh = fresh.repartition(PART)
    fresh.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/{BATCH}={batch}")
    return _write_statistics(spark, path, batch, keys, max(parts, _depth(rows, block_keys)))
