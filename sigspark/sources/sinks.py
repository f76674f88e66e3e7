"""Sinks: table saves, report exports and idempotent appends (A6–A9, A10 core)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark import config
from sigspark.errors import ValidationError
from sigspark.operators.reshape import significance_flag
from sigspark.operators.stats import sequence_index
from sigspark.sources.keyed import append_rows, stored_table  # noqa: F401

COMPOUND_KEY = ("pert_iname",)
SIGNATURE_KEY = ("pert_iname", "sig_id", "pr_gene_symbol")


def save_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each table (Parquet by default, CSV with header on request).

    An empty table is an error, checked with ``isEmpty`` (reads one row).
    """
    paths = {}
    for name, df in tables.items():
        if df.isEmpty():
            raise ValidationError(f"table {name} is empty; nothing to save")
        path = f"{out_dir.rstrip('/')}/{name}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.format(fmt).save(path)
        paths[name] = path
    return paths


def export_reports(summary: DataFrame, detailed: DataFrame, out_dir: str) -> dict[str, str]:
    """Two CSV reports with headers. The summary is a top-k list (at most
    k rows) and is written as one file for its reader; the gene-hit detail
    grows with the leads' replicate signatures and is written in parallel."""
    base = out_dir.rstrip("/")
    paths = {"lead_summary": f"{base}/lead_summary", "lead_gene_hits": f"{base}/lead_gene_hits"}
    summary.coalesce(1).write.mode("overwrite").option("header", True).csv(paths["lead_summary"])
    detailed.write.mode("overwrite").option("header", True).csv(paths["lead_gene_hits"])
    return paths


def _flag(new: DataFrame, threshold: float) -> DataFrame:
    return new.select("pert_iname", "sig_id", "pr_gene_symbol", F.col("z_score").cast("double").alias("z_score"),
                      significance_flag("z_score", threshold).alias("is_significant"))


def append_signature_batch(batch: DataFrame, path: str, threshold: float = config.Z_THRESHOLD) -> None:
    """A9 for a stream micro-batch: an empty or replayed batch appends nothing."""
    append_rows(_flag(batch, threshold), path, SIGNATURE_KEY)


def append_new_compounds(new: DataFrame, path: str) -> int:
    """Append metadata rows for compounds not yet stored; returns the count appended."""
    rows = new.count()
    if not rows:
        raise ValidationError("compound batch is empty")
    return append_rows(new, path, COMPOUND_KEY, rows)


def append_new_signatures(new: DataFrame, path: str, threshold: float = config.Z_THRESHOLD) -> int:
    """Set ``is_significant`` from the Z score and append unseen
    (compound, signature, gene) rows; returns the count appended."""
    rows = new.count()
    if not rows:
        raise ValidationError("signature batch is empty")
    return append_rows(_flag(new, threshold), path, SIGNATURE_KEY, rows)


def _positions(long: DataFrame, col_id: str) -> tuple[DataFrame, int]:
    """Column ids numbered in their order (distributed), and how many there are."""
    positioned = sequence_index(long.select(col_id).distinct(), [col_id], "__pos")
    width = positioned.count()
    if width == 0:
        raise ValidationError("matrix has no columns")
    return positioned.withColumn("__pos", F.col("__pos").cast("int")), width


def _dense(cells: Column, width: int, kind: str) -> Column:
    """Cells sorted by position → array of ``width`` values, null where there is
    no cell: the gap before each cell is filled once, so the work grows with
    the width and not with its square."""
    none = F.lit(None).cast(kind)
    size = F.size(cells)
    last = F.when(size > 0, F.element_at(cells, -1)["__pos"]).otherwise(F.lit(-1))

    def with_gap(cell, i):
        before = F.when(i > 0, F.get(cells, i - 1)["__pos"]).otherwise(F.lit(-1))
        return F.concat(F.array_repeat(none, cell["__pos"] - before - 1), F.array(cell["__v"]))

    return F.concat(F.flatten(F.transform(cells, with_gap)), F.array_repeat(none, F.lit(width - 1) - last))


def write_matrix_tsv(long: DataFrame, path: str, row_id: str = "sig_id", col_id: str = "gene_id",
                     value: str = "z_score", sep: str = "\t") -> str:
    """Long ``(row_id, col_id, value)`` → wide TSV text (the A1 input format).

    Column positions number the distinct column ids; each output row sorts its
    cells (bounded by the width) and fills the gaps in one pass, missing cells
    empty. Only the column count reaches the driver. The header is one line
    built by an aggregate; the A1 reader recognises it by content, so it may
    sit in any part file.
    """
    positioned, width = _positions(long, col_id)
    cell = F.struct("__pos", F.col(value).cast("string").alias("__v"))
    rows = (long.join(positioned, col_id, "inner").groupBy(row_id)
            .agg(F.array_sort(F.collect_list(cell)).alias("__cells"))
            .withColumn("__dense", _dense(F.col("__cells"), width, "string")))
    line = F.concat_ws(sep, F.col(row_id).cast("string"), F.array_join("__dense", sep, ""))
    header = positioned.agg(
        F.array_sort(F.collect_list(F.struct(F.col("__pos"), F.col(col_id).cast("string").alias("name"))))
        .alias("__h")).select(
        F.concat_ws(sep, F.lit(row_id), F.transform("__h", lambda x: x.getField("name"))).alias("value"))
    header.unionByName(rows.select(line.alias("value"))).write.mode("overwrite").text(path)
    return path


def write_matrix_arrays(long: DataFrame, path: str, row_id: str = "sig_id", col_id: str = "gene_id",
                        value: str = "z_score") -> str:
    """Long → dense Parquet matrix: ``rows(row_id, values array<double>)`` plus
    ``columns(__pos, col_id)``. Missing cells are null array elements.

    The wide form without a wide schema: each row is one array, positions
    number the distinct column ids, and only the column count reaches the driver.
    """
    positioned, width = _positions(long, col_id)
    cell = F.struct("__pos", F.col(value).cast("double").alias("__v"))
    rows = (long.join(positioned, col_id, "inner").groupBy(row_id)
            .agg(F.array_sort(F.collect_list(cell)).alias("__cells")))
    rows.select(row_id, _dense(F.col("__cells"), width, "double").alias("values")).write.mode("overwrite").parquet(f"{path}/rows")
    positioned.write.mode("overwrite").parquet(f"{path}/columns")
    return path
