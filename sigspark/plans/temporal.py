"""Temporal behaviour: 6 h versus 24 h (inventory G1–G7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark import config
from sigspark.functions.columns import clinical_triage as triage_rule
from sigspark.operators.reshape import strip_blanks, z_beyond
from sigspark.operators.sides import joined


def _abs_z():
    return F.abs(F.nanvl(F.col("z_score"), F.lit(None).cast("double")))


# G1
def response_features(cm: DataFrame, gs: DataFrame) -> DataFrame:
    """Per compound over significant rows: distinct genes, mean/max |Z|, sample std of Z."""
    per = (gs.where(F.col("is_significant") == 1).groupBy("pert_iname")
           .agg(F.countDistinct("pr_gene_symbol").alias("biomarker_count"),
                F.round(F.avg(_abs_z()), 6).alias("avg_response"), F.max(_abs_z()).alias("max_response"),
                F.round(F.stddev_samp("z_score"), 6).alias("response_variability")))
    return joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")


# G2
def time_metrics(gs: DataFrame, sig_info: DataFrame, compounds: DataFrame | None = None,
                 time_points: Sequence[str] = config.TIME_POINTS,
                 threshold: float = config.Z_THRESHOLD) -> DataFrame:
    """Max |Z| and distinct genes per (compound, time point) at |Z| ≥ threshold."""
    rows = gs.where(z_beyond(threshold))
    if compounds is not None:
        rows = rows.join(compounds.select("pert_iname"), "pert_iname", "left_semi")
    times = sig_info.where(F.col("pert_itime").isin(list(time_points))).select("sig_id", "pert_iname", "pert_itime")
    return (joined(rows, times, ["sig_id", "pert_iname"]).groupBy("pert_iname", "pert_itime")
            .agg(F.max(_abs_z()).alias("max_potency"), F.countDistinct("pr_gene_symbol").alias("affected_genes")))


# G3
def time_pivot_delta(metrics: DataFrame, early: str = "6h", late: str = "24h") -> DataFrame:
    """One row per compound with both time points side by side and the gene delta.

    Explicit pivot values: a time point missing from the data gives null
    columns instead of a missing column.
    """
    t = strip_blanks("pert_itime")

    def at(label, col):
        return F.max(F.when(t == label, F.col(col)))

    wide = metrics.groupBy("pert_iname").agg(
        at(early, "max_potency").alias(f"Max_Potency_{early}"), at(late, "max_potency").alias(f"Max_Potency_{late}"),
        at(early, "affected_genes").cast("long").alias(f"Affected_Genes_{early}"),
        at(late, "affected_genes").cast("long").alias(f"Affected_Genes_{late}"))
    return wide.withColumn("Gene_Delta", F.col(f"Affected_Genes_{late}") - F.col(f"Affected_Genes_{early}"))


# G4
def clinical_triage(pivot: DataFrame, cascade_delta: int = config.CASCADE_DELTA,
                    rapid_genes: int = config.RAPID_GENES_6H) -> DataFrame:
    return pivot.withColumn("Clinical_Profile",
                            triage_rule("Affected_Genes_6h", "Gene_Delta", cascade_delta, rapid_genes))


# G5
def late_new_hits(gs: DataFrame, sig_info: DataFrame, early: str = "6 h", late: str = "24 h",
                  threshold: float = config.Z_THRESHOLD) -> DataFrame:
    """Genes hit at the late time point that the compound did not hit early."""
    rows = joined(gs.where(z_beyond(threshold)), sig_info.select("sig_id", "pert_iname", "pert_itime"), ["sig_id", "pert_iname"])
    late_hits = rows.where(F.col("pert_itime") == late).select("pert_iname", "pr_gene_symbol").distinct()
    early_hits = rows.where(F.col("pert_itime") == early).select("pert_iname", "pr_gene_symbol").distinct()
    return joined(late_hits, early_hits, ["pert_iname", "pr_gene_symbol"], "left_anti")


# G6
def large_shift(pivot: DataFrame, threshold: int = config.CASCADE_DELTA) -> DataFrame:
    d = F.col("Gene_Delta")
    return pivot.select("pert_iname", "Gene_Delta",
                        F.coalesce(F.abs(d) >= threshold, F.lit(False)).alias("large_shift"),
                        F.when(d > 0, "expansion").when(d < 0, "contraction").when(d == 0, "none")
                        .alias("shift_direction"))


# G7
def leads_per_time(cm: DataFrame, gs: DataFrame, sig_info: DataFrame, n: int = config.TOP_N_LEADS,
                   max_genes: int = config.MAX_AFFECTED_GENES, min_potency: float = config.MIN_POTENCY) -> DataFrame:
    """Top-n precision leads separately at each time point.

    ``row_number() <= n`` over a window is planned with a per-partition
    group limit before the shuffle, so a large time point is cut to n rows
    per map task first.
    """
    rows = joined(gs, sig_info.select("sig_id", "pert_iname", "pert_itime"), ["sig_id", "pert_iname"])
    per = (rows.groupBy("pert_itime", "pert_iname")
           .agg(F.max(_abs_z()).alias("max_potency"), F.countDistinct("pr_gene_symbol").alias("total_gene_hits"))
           .where((F.col("total_gene_hits") <= max_genes) & (F.col("max_potency") >= F.lit(float(min_potency)))))
    per = joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")
    w = Window.partitionBy("pert_itime").orderBy(F.col("max_potency").desc(), F.col("pert_iname"))
    return (per.withColumn("time_rank", F.row_number().over(w).cast("long")).where(F.col("time_rank") <= n)
            .select("pert_itime", "time_rank", "pert_iname", "max_potency", "total_gene_hits"))
