"""Helpers shared by the operators: landed tables, free column names and the
vectorised word scan over Arrow batches."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.session import scratch_root

WORD, SPACES = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]+"
# Text bytes that one vectorised step works on; a longer document is a step of its own.
STEP_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of this application (once), and
    keep Arrow batches of whole texts small unless the session says otherwise."""
    if spark.conf.get(BATCH_BYTES) == "67108864b":  # the default
        spark.conf.set(BATCH_BYTES, "8m")
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.relpath(path, os.path.dirname(root)))
    folder = tempfile.mkdtemp()  # on the driver, which serves the file while it lives
    atexit.register(shutil.rmtree, folder, True)
    path = os.path.join(folder, f"{os.path.basename(root)}-{uuid.uuid4().hex}.zip")
    with open(path, "wb") as f:
        f.write(data.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    lineage is cut, and a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def free_prefix(df: DataFrame, prefix: str) -> str:
    """A prefix that no column of ``df`` has."""
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def text_bytes(column):
    """The UTF-8 bytes of a text column; null stays null."""
    return F.col(column).cast("binary") if isinstance(column, str) else column.cast("binary")


def flat(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte array with all values end to end, and their offsets; nulls are empty."""
    values = values.cast(pa.large_binary())
    if values.null_count:
        values = values.fill_null(b"")
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def steps(at: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row at least)."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def word_bounds(raw: np.ndarray, at: np.ndarray, space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per row the index of its first word
    (one more entry than rows). Words never cross rows."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~space[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edge = at[:-1][at[:-1] < n]
    first[edge] |= inside[edge]
    edge = at[1:][at[1:] > 0] - 1
    last[edge] |= inside[edge]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, at)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * _ODD
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit value per word from its first and last eight bytes and its
    length: equal words get equal values. Different words may share one, so
    users compare the bytes before they act on a match."""
    padded = np.concatenate([np.zeros(8, np.uint8), raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    size = end - start
    head = eight[start + 8] & _MASK[np.minimum(size, 8)]
    tail = np.where(size > 8, eight[end], np.uint64(0))
    return mix(head * _ODD + mix(tail + size.astype(np.uint64)))


def gram_hashes(words: np.ndarray, m: int) -> np.ndarray:
    """Hash of every run of ``m`` words; entry i covers words i..i+m-1."""
    n = len(words) - m + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    factor = int(_ODD)
    for j in range(m):
        out += words[j:j + n] * np.uint64(factor)
        factor = (factor * int(_ODD) + 2) & 0xFFFFFFFFFFFFFFFF
    return mix(out)


def bit_index(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.int64)


class Bitmap:
    """A set of 64-bit hashes as 2**bits bits: every member tests true, few
    others do while it is sparse. It travels compressed, so a sparse one is
    small; its size never exceeds 2**bits / 8 bytes."""

    def __init__(self, words: np.ndarray, bits: int):
        self.bits, self._packed = bits, zlib.compress(words.tobytes(), 1)

    def __getstate__(self):
        return {"bits": self.bits, "_packed": self._packed}

    @cached_property
    def _bytes(self) -> np.ndarray:
        return np.frombuffer(zlib.decompress(self._packed), np.uint8)

    def test(self, h: np.ndarray) -> np.ndarray:
        i = bit_index(h, self.bits)
        return (self._bytes[i >> 3] >> (i & 7).astype(np.uint8)) & 1 == 1


def hash_bitmap(hashes: DataFrame, column: str, bits: int) -> Bitmap:
    """A bitmap over a column of 64-bit hashes. Executors set the bits; the
    driver gets the non-empty 64-bit words, 2**bits / 64 of them at most
    whatever the input's size."""
    def words(batches):
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            i = bit_index(h, bits)
            yield pa.RecordBatch.from_arrays([pa.array(i >> 6), pa.array((np.uint64(1) << (i & 63).astype(np.uint64)).view(np.int64))],
                                             names=["word", "mask"])

    got = (hashes.select(F.col(column).cast("long").alias("h")).mapInArrow(words, "word long, mask long")
           .groupBy("word").agg(F.bit_or("mask").alias("mask"))).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    return Bitmap(out, bits)


def bitmap_test(bitmap):
    """A column function over 64-bit hashes: whether they test true in the broadcast bitmap."""
    @F.pandas_udf("boolean")
    def test(h: pd.Series) -> pd.Series:
        return pd.Series(bitmap.value.test(h.to_numpy(np.int64).view(np.uint64)))

    return test
