"""Readers for the reference's input formats (inventory A1–A4).

* A1 wide matrix TSV: read as text lines and exploded by position, so the
  width never becomes a Spark schema (a 10⁵-column header would be a
  10⁵-field plan); header positions are joined back as a small table.
* A2 metadata TSV (plain or gzip): explicit schema-less string read,
  pandas-style missing tokens normalised to null, then typed casts. A gzip
  file is one task, so the result is repartitioned straight after the read.
* A3 mechanism list with '!' comment lines: CSV reader ``comment`` option.
* A4 column-pruned read: a ``select`` — Catalyst prunes the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark import config
from sigspark.errors import ValidationError, require_columns


def _missing_to_null(c: str):
    return F.when(F.col(c).isin(list(config.MISSING_TOKENS)), F.lit(None)).otherwise(F.col(c))


def read_matrix_tsv(spark: SparkSession, path: str, row_id: str = "gene_id", col_id: str = "sig_id",
                    value: str = "z_score", sep: str = "\t", id_header: str | None = None) -> DataFrame:
    """A1: wide TSV (first field = row id, header names the columns) → long
    ``(row_id, col_id, value)``; empty / missing cells are kept as null.

    Header lines are recognised by content (first field = ``id_header``,
    default ``row_id``), so every part file may repeat the header and a
    split file never mislabels a data line. All headers must be equal. The
    test looks at a line's first characters, before any splitting; only data
    lines are split for their cells, and only header lines for the names.
    """
    lines = spark.read.text(path)
    is_header = F.col("value").startswith(f"{id_header or row_id}{sep}")
    names = (lines.where(is_header).distinct().select(F.posexplode(F.split("value", sep)).alias("__pos", col_id))
             .where(F.col("__pos") > 0))
    fields = lines.where(~is_header).select(F.split("value", sep).alias("__f"))
    cells = fields.select(F.col("__f")[0].alias(row_id), F.posexplode(F.col("__f")).alias("__pos", "__raw")).where(F.col("__pos") > 0)
    raw = F.when(F.col("__raw").isin(list(config.MISSING_TOKENS)), F.lit(None)).otherwise(F.col("__raw"))
    # The header table has one row per column; Spark broadcasts it when its
    # measured size allows (any realistic width) and shuffles otherwise.
    return (cells.join(names, "__pos", "inner")
            .select(row_id, col_id, raw.try_cast("double").alias(value)))


def read_metadata_tsv(spark: SparkSession, path: str, types: dict[str, str] | None = None,
                      compression: str | None = None, partitions: int | None = None,
                      comment: str | None = None) -> DataFrame:
    """A2: TSV with header (gzip detected from the extension or ``compression``)."""
    reader = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False)
    if comment:
        reader = reader.option("comment", comment)
    if compression:
        reader = reader.option("compression", compression)
    df = reader.csv(path)
    df = df.select(*[_missing_to_null(c).alias(c) for c in df.columns])
    for c, t in (types or {}).items():
        df = df.withColumn(c, F.col(c).cast(t))
    if partitions or (compression == "gzip" or str(path).endswith(".gz")):
        df = df.repartition(partitions or spark.sparkContext.defaultParallelism)
    return df


def read_commented_tsv(spark: SparkSession, path: str, types: dict[str, str] | None = None,
                       comment: str = "!") -> DataFrame:
    """A3: TSV whose comment lines start with ``comment``."""
    return read_metadata_tsv(spark, path, types=types, comment=comment)


def read_pruned(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """A4: keep only ``columns`` (pushed into the scan's ReadSchema)."""
    require_columns(df, columns, "pruned read")
    return df.select(*columns)


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """A5: fail before planning when an input is missing."""
    missing = []
    for p in paths:
        try:
            spark.read.format("binaryFile").load(p).limit(0).collect()
        except AnalysisException:
            missing.append(p)
    if missing:
        raise ValidationError(f"missing inputs: {missing}")


def read_matrix_arrays(spark: SparkSession, path: str, row_id: str = "sig_id", col_id: str = "gene_id",
                       value: str = "z_score") -> DataFrame:
    """A1, Parquet form: ``rows(row_id, values array)`` + ``columns(__pos, col_id)``
    → long ``(row_id, col_id, value)``, null cells kept. ``posexplode`` runs
    per row inside the scan stage; the column table is width-sized and is
    broadcast when its measured size allows."""
    rows = spark.read.parquet(f"{path}/rows")
    cols = spark.read.parquet(f"{path}/columns")
    cells = rows.select(row_id, F.posexplode("values").alias("__pos", value))
    return cells.join(cols, "__pos", "inner").select(row_id, col_id, value)
