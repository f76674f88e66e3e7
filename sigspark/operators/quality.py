"""Data quality, statistics, outliers and normalisation (inventory D1–D18).

Whole-table scalars (mean, std, min, max, quartiles) are computed once as a
one-row aggregate and attached with ``with_scalars`` (scalar subqueries),
never with a single-partition window. Quartiles are exact and distributed
(``exact_quantiles``); ``approx=True`` switches to ``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark import config
from sigspark.errors import ValidationError, require_columns
from sigspark.operators.joins import orphaned_signatures
from sigspark.operators.reshape import coerce_numeric, nan_as_null, number
from sigspark.operators.sides import joined
from sigspark.operators.stats import exact_quantiles, moments, with_scalars


def _r(c: Column, d: int = 6) -> Column:
    return F.round(c, d)


def _nonempty(n: Column, what: str) -> Column:
    """Lazily fail the job when a required input is empty."""
    return F.when(n == 0, F.raise_error(F.lit(f"{what} is empty"))).otherwise(n)


# D1
def gene_statistics(gs: DataFrame) -> DataFrame:
    az = F.abs(F.nanvl(F.col("z_score"), F.lit(None).cast("double")))
    return (gs.where(F.col("is_significant") == 1).groupBy("pr_gene_symbol")
            .agg(F.countDistinct("pert_iname").alias("compound_count"), _r(F.avg(az)).alias("avg_abs_z_score"),
                 F.max(az).alias("max_abs_z_score"), F.min(az).alias("min_abs_z_score"),
                 F.count(F.lit(1)).alias("total_occurrences"))
            .orderBy(F.col("total_occurrences").desc(), "pr_gene_symbol"))


# D2
def compound_profile_summary(cm: DataFrame, gs: DataFrame) -> DataFrame:
    """Per compound: metadata, significant hits and total rows (0 when none)."""
    per = gs.groupBy("pert_iname").agg(
        F.sum(F.when(F.col("is_significant") == 1, 1).otherwise(0)).cast("long").alias("significant_hits"),
        F.count(F.lit(1)).alias("total_affected_genes"))
    return (joined(cm, per, "pert_iname", "left")
            .select(*cm.columns, F.coalesce("significant_hits", F.lit(0)).cast("long").alias("significant_hits"),
                    F.coalesce("total_affected_genes", F.lit(0)).cast("long").alias("total_affected_genes")))


def compound_profile_detail(gs: DataFrame, compound: str) -> DataFrame:
    return gs.where(F.col("pert_iname") == compound).orderBy(F.abs(F.col("z_score")).desc(), "pr_gene_symbol", "sig_id")


def _one_row(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = with_scalars(out, f)
    return out


# D3
def integrity_report(cm: DataFrame, gs: DataFrame) -> DataFrame:
    compounds = cm.agg(F.count(F.lit(1)).alias("compound_count"))
    sigs = gs.agg(F.count(F.lit(1)).alias("signature_count"),
                  F.coalesce(F.sum(F.when(F.col("is_significant") == 1, 1).otherwise(0)), F.lit(0))
                  .cast("long").alias("significant_count"))
    orphans = orphaned_signatures(gs, cm).agg(F.count(F.lit(1)).alias("orphaned_signatures"))
    out = _one_row(compounds, sigs, orphans)
    pct = F.when(F.col("signature_count") > 0, F.col("significant_count") * 100.0 / F.col("signature_count")) \
           .otherwise(F.lit(0.0))
    return out.select("compound_count", "signature_count", "significant_count", "orphaned_signatures",
                      _r(pct).alias("significant_percentage"))


# D4
def null_profile(df: DataFrame) -> DataFrame:
    """Per column: null count and null % (2 decimals); NaN counts as null."""
    df = nan_as_null(df)
    n = F.count(F.lit(1))
    wide = df.agg(_nonempty(n, "input frame").alias("__rows"),
                  *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    long = wide.unpivot(["__rows"], list(df.columns), "column", "null_count")
    return long.select("column", F.col("null_count").cast("long").alias("null_count"),
                       _r(F.col("null_count") * 100.0 / F.col("__rows"), 2).alias("null_pct"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows minus distinct rows (nulls compare equal), as a one-row frame."""
    total = df.agg(F.count(F.lit(1)).alias("__rows"))
    distinct = df.distinct().agg(F.count(F.lit(1)).alias("__distinct"))
    return _one_row(total, distinct).select("__rows", (F.col("__rows") - F.col("__distinct")).alias("duplicates"))


def quality_report(df: DataFrame, max_null_share: float = config.MAX_NULL_SHARE,
                   max_duplicate_share: float = config.MAX_DUPLICATE_SHARE) -> DataFrame:
    """One row: shape, total nulls (NaN among them), duplicates and the two warning flags."""
    df = nan_as_null(df)
    nulls = df.agg(_nonempty(F.count(F.lit(1)), "input frame").alias("n_rows"),
                   *[F.sum(F.col(c).isNull().cast("long")).alias(f"__null_{i}") for i, c in enumerate(df.columns)])
    null_cols = [F.col(f"__null_{i}") for i in range(len(df.columns))]
    out = _one_row(nulls, duplicate_count(df))
    worst = F.greatest(*[c / F.col("n_rows") for c in null_cols]) if len(null_cols) > 1 else null_cols[0] / F.col("n_rows")
    return out.select(
        F.col("n_rows").cast("long").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        sum(null_cols[1:], null_cols[0]).cast("long").alias("total_nulls"),
        F.col("duplicates").cast("long").alias("duplicates"),
        _r(F.col("duplicates") / F.col("n_rows")).alias("duplicate_ratio"),
        (worst > F.lit(max_null_share)).alias("warn_nulls"),
        (F.col("duplicates") / F.col("n_rows") > F.lit(max_duplicate_share)).alias("warn_duplicates"))


# D5
def quality_gates(expression: DataFrame, cm: DataFrame, gs: DataFrame, key_columns: Sequence[str],
                  max_null_share: float = config.MAX_NULL_SHARE,
                  max_duplicate_share: float = config.MAX_DUPLICATE_SHARE,
                  mean_tolerance: float = 0.5, sd_range: tuple[float, float] = (0.5, 2.0)) -> DataFrame:
    """Documented gates as booleans over D3/D4/D7 metrics (one row)."""
    require_columns(expression, key_columns, "gate input")
    expression = nan_as_null(expression)
    n = F.count(F.lit(1))
    stats = expression.agg(
        n.alias("__n"), F.avg("z_score").alias("z_mean"), F.stddev_samp("z_score").alias("z_sd"),
        *[F.sum(F.col(c).isNull().cast("long")).alias(f"__null_{i}") for i, c in enumerate(key_columns)])
    worst = F.greatest(*[F.try_divide(F.col(f"__null_{i}"), F.col("__n")) for i in range(len(key_columns))], F.lit(0.0))
    dup_share = F.try_divide(F.col("__dups"), F.col("__n"))
    dup = duplicate_count(expression.select(*key_columns)).select(F.col("duplicates").alias("__dups"))
    orphans = orphaned_signatures(gs, cm).agg(F.count(F.lit(1)).alias("orphaned_signatures"))
    out = _one_row(stats, dup, orphans)
    return out.select(
        _r(worst).alias("max_null_share"), _r(dup_share).alias("duplicate_share"),
        _r(F.col("z_mean")).alias("z_mean"), _r(F.col("z_sd")).alias("z_sd"), "orphaned_signatures",
        (worst < F.lit(max_null_share)).alias("nulls_ok"),
        (dup_share < F.lit(max_duplicate_share)).alias("duplicates_ok"),
        (F.abs(F.col("z_mean")) <= F.lit(mean_tolerance)).alias("mean_ok"),
        F.col("z_sd").between(sd_range[0], sd_range[1]).alias("sd_ok"),
        (F.col("orphaned_signatures") == 0).alias("no_orphans"))


# D6
def data_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, total nulls, null %, duplicates, and type counts."""
    df = nan_as_null(df)
    types: dict[str, int] = {}
    for _, t in df.dtypes:
        types[t] = types.get(t, 0) + 1
    nulls = df.agg(F.count(F.lit(1)).alias("rows"),
                   *[F.sum(F.col(c).isNull().cast("long")).alias(f"__null_{i}") for i, c in enumerate(df.columns)])
    total = sum([F.col(f"__null_{i}") for i in range(len(df.columns))][1:], F.col("__null_0"))
    cells = F.col("rows") * F.lit(len(df.columns))
    dtype_text = ",".join(f"{t}:{n}" for t, n in sorted(types.items()))
    return _one_row(nulls, duplicate_count(df)).select(
        F.col("rows").cast("long").alias("rows"), F.lit(len(df.columns)).alias("columns"),
        total.cast("long").alias("null_count"),
        _r(F.when(cells > 0, total * 100.0 / cells)).alias("null_percentage"),
        F.col("duplicates").cast("long").alias("duplicates"), F.lit(dtype_text).alias("dtypes"))


# D7
def column_statistics(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """count, mean, median, sample std, min, max, q1, q3, skewness, kurtosis (pandas estimators)."""
    require_columns(df, [column], "statistics input")
    vals = df.select(coerce_numeric(column).alias("__x")).where(F.col("__x").isNotNull() & ~F.isnan("__x"))
    m = vals.agg(*moments(F.col("__x")))
    if approx:
        q = vals.agg(*[F.percentile_approx("__x", p, 10000).alias(n)
                       for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])
    else:
        q = exact_quantiles(vals, "__x", [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    out = _one_row(m, q)
    return out.select(F.col("count").cast("long").alias("count"), _r(F.col("mean")).alias("mean"),
                      _r(F.col("median")).alias("median"), _r(F.col("std")).alias("std"), "min", "max",
                      _r(F.col("q1")).alias("q1"), _r(F.col("q3")).alias("q3"),
                      _r(F.col("skewness")).alias("skewness"), _r(F.col("kurtosis")).alias("kurtosis"))


# D8
def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    return (df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), column))


# D9
def extra_time_points(sig_info: DataFrame, standard: Sequence[str] = config.TIME_POINTS) -> DataFrame:
    return (sig_info.where(F.col("pert_itime").isNotNull() & ~F.col("pert_itime").isin(list(standard)))
            .select("pert_itime").distinct())


def _quartiles(df: DataFrame, column: str, approx: bool) -> DataFrame:
    if approx:
        return df.agg(F.percentile_approx(column, 0.25, 10000).alias("__q1"),
                      F.percentile_approx(column, 0.5, 10000).alias("__med"),
                      F.percentile_approx(column, 0.75, 10000).alias("__q3"))
    return exact_quantiles(df, column, [0.25, 0.5, 0.75], names=["__q1", "__med", "__q3"])


# D10
def outliers_iqr(df: DataFrame, column: str, threshold: float = config.OUTLIER_THRESHOLD,
                 approx: bool = False) -> DataFrame:
    """Flag strict ``x < Q1 - k·IQR`` or ``x > Q3 + k·IQR``."""
    require_columns(df, [column], "outlier input")
    out = with_scalars(df, _quartiles(df, column, approx))
    iqr = F.col("__q3") - F.col("__q1")
    x = number(df, column)
    flag = (x < F.col("__q1") - F.lit(threshold) * iqr) | (x > F.col("__q3") + F.lit(threshold) * iqr)
    return out.withColumn("is_outlier", F.coalesce(flag, F.lit(False))).drop("__q1", "__med", "__q3")


# D11
def outliers_zscore(df: DataFrame, column: str, threshold: float = config.OUTLIER_THRESHOLD) -> DataFrame:
    """Flag ``|x - mean| / population std > threshold``; a zero std flags nothing."""
    require_columns(df, [column], "outlier input")
    x = number(df, column)
    stats = df.agg(F.avg(x).alias("__mean"), F.stddev_pop(x).alias("__sd"))
    z = F.try_divide(F.abs(x - F.col("__mean")), F.col("__sd"))
    flag = F.coalesce(F.when(F.col("__sd") > 0, z > F.lit(threshold)), F.lit(False))
    return with_scalars(df, stats).withColumn("is_outlier", flag).drop("__mean", "__sd")


# D12–D14
def normalize(df: DataFrame, column: str = "z_score", method: str = "standard", approx: bool = False) -> DataFrame:
    """Add ``<column>_normalized``: standard (population std), minmax or robust.

    A zero denominator gives null (numpy gives NaN/inf).
    """
    require_columns(df, [column], "normalisation input")
    x = number(df, column)
    if method == "standard":
        stats = df.agg(F.avg(x).alias("__a"), F.stddev_pop(x).alias("__b"))
        value = F.try_divide(x - F.col("__a"), F.col("__b"))
    elif method == "minmax":
        stats = df.agg(F.min(x).alias("__a"), F.max(x).alias("__m"))
        value = F.try_divide(x - F.col("__a"), F.col("__m") - F.col("__a"))
    elif method == "robust":
        stats = _quartiles(df, column, approx)
        value = F.try_divide(x - F.col("__med"), F.col("__q3") - F.col("__q1"))
    else:
        raise ValidationError(f"unknown normalisation method {method!r}")
    scratch = [c for c in stats.columns]
    value = F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), F.lit(None)).otherwise(value)
    return with_scalars(df, stats).withColumn(f"{column}_normalized", _r(value)).drop(*scratch)


# D16
def share_of_total(df: DataFrame, column: str, name: str = "share_pct") -> DataFrame:
    total = df.agg(F.sum(number(df, column)).alias("__total"))
    return (with_scalars(df, total)
            .withColumn(name, _r(F.try_divide(F.col(column) * 100.0, F.col("__total")))).drop("__total"))


# D17
def validate_frame(df: DataFrame, required_columns: Sequence[str] = (), min_rows: int = 1) -> DataFrame:
    """Schema check now; row check lazily (reads at most ``min_rows`` rows)."""
    require_columns(df, required_columns, "frame")
    n = df.limit(min_rows).agg(F.count(F.lit(1)).alias("__n"))
    return n.select(F.when(F.col("__n") >= min_rows, F.lit(True))
                    .otherwise(F.raise_error(F.lit(f"frame has fewer than {min_rows} rows"))).alias("valid"))


# D18
def consensus_signature(df: DataFrame) -> DataFrame:
    """One mean Z per (compound, gene) over replicate signatures."""
    return df.groupBy("pert_iname", "pr_gene_symbol").agg(_r(F.avg(number(df, "z_score"))).alias("mean_z"),
                                                         F.count(F.lit(1)).alias("n_replicates"))
