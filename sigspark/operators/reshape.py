"""Projection, filter and reshape operators (inventory B1–B17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark import config
from sigspark.errors import ValidationError, require_columns
from sigspark.operators.sides import joined


def landmark_genes(gene_info: DataFrame) -> DataFrame:
    """B1: landmark genes (``pr_is_lm = 1``)."""
    return gene_info.where(F.col("pr_is_lm") == 1).select("pr_gene_id", "pr_gene_symbol")


def target_signatures(sig_info: DataFrame, cell: str = config.TARGET_CELL, dose: float = config.TARGET_DOSE,
                      units: Sequence[str] = config.TARGET_DOSE_UNITS) -> DataFrame:
    """B2: signatures of one cell line at one dose (either spelling of the micro unit)."""
    return sig_info.where((F.col("cell_id") == cell) & (F.col("pert_dose") == F.lit(float(dose)))
                          & F.col("pert_dose_unit").isin(list(units)))


def treatment_only(df: DataFrame, sig_info: DataFrame, pert_type: str = config.TREATMENT_TYPE) -> DataFrame:
    """Keep rows whose signature is a compound treatment (semi join on ``sig_id``)."""
    keep = sig_info.where(F.col("pert_type") == pert_type).select("sig_id")
    return joined(df, keep, "sig_id", "left_semi")


def valid_ids(wanted: DataFrame, present: DataFrame, column: str) -> DataFrame:
    """Wanted ids that also occur in the matrix, as a set.

    The matrix side repeats each id once per cell; it is made distinct first,
    map-side, so one row per id and task is shuffled."""
    return wanted.select(column).intersect(present.select(column).distinct())


def extract_submatrix(matrix_long: DataFrame, gene_ids: DataFrame, sig_ids: DataFrame) -> DataFrame:
    """Matrix cells whose gene and signature are both wanted (two semi joins).

    A short id list may be broadcast; the signatures grow with the matrix and
    are then joined by shuffle.
    """
    cells = joined(matrix_long, gene_ids.select(F.col("pr_gene_id").alias("gene_id")), "gene_id", "left_semi")
    return joined(cells, sig_ids.select("sig_id"), "sig_id", "left_semi")


def melt_wide_to_long(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str] | None = None,
                      var_name: str = "gene", value_name: str = "z_score") -> DataFrame:
    """Wide to long, keeping null cells (pandas ``melt`` semantics)."""
    require_columns(df, id_vars, "melt input")
    values = [c for c in (value_vars or df.columns) if c not in id_vars]
    return df.unpivot(list(id_vars), values, var_name, value_name)


def stack_matrix(df: DataFrame, id_vars: Sequence[str], value_vars: Sequence[str] | None = None,
                 var_name: str = "gene", value_name: str = "z_score") -> DataFrame:
    """Like B6 but null and NaN cells are dropped (pandas ``stack`` semantics)."""
    long = melt_wide_to_long(df, id_vars, value_vars, var_name, value_name)
    return long.where(present(long, value_name))


def present(df: DataFrame, column: str) -> Column:
    """Neither null nor, for floating columns, NaN (pandas' missing value)."""
    there = F.col(column).isNotNull()
    floating = df.schema[column].dataType.typeName() in ("double", "float")
    return there & ~F.isnan(column) if floating else there


def number(df: DataFrame, column: str) -> Column:
    """The column with NaN as null: aggregates pass over it and comparisons are not true."""
    floating = df.schema[column].dataType.typeName() in ("double", "float")
    return F.nullif(F.col(column), F.lit(float("nan"))) if floating else F.col(column)


def nan_as_null(df: DataFrame) -> DataFrame:
    return df.select(*[number(df, c).alias(c) for c in df.columns])


def z_above(threshold: float, column: str = "z_score") -> Column:
    """``z > t`` in a form that Parquet scans can use; false for NaN, which Spark orders above every number."""
    return (F.col(column) > F.lit(float(threshold))) & ~F.isnan(column)


def filter_by_z_score(df: DataFrame, column: str = "z_score", threshold: float = config.Z_THRESHOLD) -> DataFrame:
    """Keep ``abs(z) >= threshold``; a null or NaN Z is dropped.

    Written as ``z >= t OR z <= -t`` so the scan can push it into Parquet
    (``abs`` cannot be pushed); Spark orders NaN above every number, hence
    the explicit NaN test (pandas drops NaN here).
    """
    require_columns(df, [column], "z filter input")
    z, t = F.col(column), F.lit(float(threshold))
    return df.where(((z >= t) | (z <= -t)) & ~F.isnan(z))


def z_beyond(threshold: float, column: str = "z_score", strict: bool = False) -> Column:
    """``abs(z) >= t`` (or ``> t``) in a form that Parquet scans can use; false for NaN."""
    z, t, minus = F.col(column), F.lit(float(threshold)), F.lit(-float(threshold))
    return (((z > t) | (z < minus)) if strict else ((z >= t) | (z <= minus))) & ~F.isnan(z)


def significance_flag(z: Column | str = "z_score", threshold: float = config.Z_THRESHOLD) -> Column:
    """1 when ``z >= t or z <= -t`` else 0 (null and NaN: 0)."""
    z = F.col(z) if isinstance(z, str) else z
    z, t = F.nanvl(z.cast("double"), F.lit(None).cast("double")), F.lit(float(threshold))
    return F.when((z >= t) | (z <= -t), F.lit(1)).otherwise(F.lit(0)).cast("int")


def z_tier(z: Column | str = "z_score", significant: float = config.Z_THRESHOLD,
           high: float = config.HIGH_CONFIDENCE_Z, extreme: float = config.EXTREME_Z) -> Column:
    """Tier by ``abs(z)``: > 4 extreme, > 3 high-confidence, > 2 significant; null and NaN are not significant."""
    z = F.col(z) if isinstance(z, str) else z
    a = F.abs(F.nanvl(z.cast("double"), F.lit(None).cast("double")))
    return (F.when(a > F.lit(float(extreme)), "extreme")
            .when(a > F.lit(float(high)), "high_confidence")
            .when(a > F.lit(float(significant)), "significant")
            .otherwise("not_significant"))


def z_direction(z: Column | str = "z_score") -> Column:
    """Sign of the response: up / down / none (null and NaN: none)."""
    z = F.col(z) if isinstance(z, str) else z
    z = F.nanvl(z.cast("double"), F.lit(None).cast("double"))
    return F.when(z > 0, "up").when(z < 0, "down").otherwise("none")


def dedupe(df: DataFrame, subset: Sequence[str], order_by: Sequence[str], keep: str | bool = "first") -> DataFrame:
    """Drop duplicate keys, keeping the first / last row by ``order_by``, or none.

    Files have no row order in Spark, so the order is explicit. Written as
    ``row_number() <= k`` over the key, which Spark plans with a partial
    WindowGroupLimit before the shuffle: each map task forwards at most k
    rows per key, so a key holding a third of the table never reaches one
    task whole. ``keep=False`` keeps two rows per key that way, then drops
    keys that still have two.
    """
    require_columns(df, list(subset) + list(order_by), "dedupe input")
    if keep not in ("first", "last", "none", False):
        raise ValidationError(f"keep must be 'first', 'last' or False, got {keep!r}")
    order = [F.col(c).desc_nulls_last() if keep == "last" else F.col(c).asc_nulls_first() for c in order_by]
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*subset).orderBy(*order)))
    if keep in ("first", "last"):
        return ranked.where(F.col("__rn") == 1).drop("__rn")
    pairs = ranked.where(F.col("__rn") <= 2)
    counted = pairs.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*subset)))
    return counted.where(F.col("__n") == 1).drop("__rn", "__n")


def safe_cast(df: DataFrame, column: str, dtype: str, fill=None) -> DataFrame:
    """Strict cast, then fill nulls.

    A non-null value that does not convert fails the job — by ANSI casting
    when the session has it on, and by an explicit check otherwise.
    """
    require_columns(df, [column], "cast input")
    src, cast = F.col(column), F.col(column).cast(dtype)
    strict = F.when(src.isNotNull() & src.try_cast(dtype).isNull(),
                    F.raise_error(F.concat(F.lit(f"cannot cast {column} value to {dtype}: "), src.cast("string"))))
    out = df.withColumn(column, F.coalesce(strict, cast))
    return out.fillna({column: fill}) if fill is not None else out


def coerce_numeric(c: Column | str) -> Column:
    """Numeric coercion; values that do not parse become null."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("double")


def strip_blanks(c: Column | str) -> Column:
    """B14: '6 h' -> '6h'."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, " ", "")


def preview_rows(df: DataFrame, order_by: Sequence[str], n: int = 20, offset: int = 0) -> DataFrame:
    """Deterministic head/slice for inspection (the limit is the feature)."""
    out = df.orderBy(*order_by)
    if offset:
        out = out.offset(offset)
    return out.limit(n)


def masked(c: Column | str, threshold: float = config.Z_THRESHOLD) -> Column:
    """Hide cells with ``abs < threshold``, and NaN."""
    c = F.col(c) if isinstance(c, str) else c
    c = F.nanvl(c.cast("double"), F.lit(None).cast("double"))
    return F.when(F.abs(c) >= F.lit(float(threshold)), c)
