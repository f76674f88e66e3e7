"""Composite lead score card: the seven translation criteria (inventory E11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark import config
from sigspark.operators.sides import joined
from sigspark.plans.literature import compound_literature
from sigspark.plans.questions import _is_unknown, reversal_general
from sigspark.plans.temporal import time_metrics, time_pivot_delta

CRITERIA = ("high_potency", "high_specificity", "moa_clarity", "limited_extreme", "reversal_match",
            "stable_over_time", "novel_literature")


def lead_scorecard(cm: DataFrame, gs: DataFrame, sig_info: DataFrame, corpus_index: DataFrame, postings: DataFrame,
                   disease: DataFrame, min_potency: float = config.MIN_POTENCY, max_genes: int = config.MAX_AFFECTED_GENES,
                   extreme: float = config.EXTREME_Z, max_extreme_genes: int = config.RISK_MAX_EXTREME_GENES,
                   shift: int = config.CASCADE_DELTA, novelty: int = config.NOVELTY_THRESHOLD) -> DataFrame:
    """One row per compound with the seven booleans and how many hold.

    Every input is per-compound (aggregates, a reversal list, the time
    pivot, literature counts), so the final joins are compound-keyed.
    """
    az = F.abs(F.nanvl(F.col("z_score"), F.lit(None).cast("double")))
    per = gs.groupBy("pert_iname").agg(
        F.max(az).alias("max_potency"), F.countDistinct("pr_gene_symbol").alias("affected_genes"),
        F.countDistinct(F.when(az > F.lit(float(extreme)), F.col("pr_gene_symbol"))).alias("extreme_genes"))
    base = joined(per, cm.select("pert_iname", "moa"), "pert_iname", "inner")
    reversed_ = reversal_general(cm, gs, disease).select("pert_iname", F.lit(True).alias("__rev"))
    pivot = time_pivot_delta(time_metrics(gs, sig_info)).select("pert_iname", "Gene_Delta")
    papers = compound_literature(corpus_index, cm.select("pert_iname"), postings).select("pert_iname", "pubmed_papers")
    moa = F.col("moa")
    known_moa = moa.isNotNull() & (moa != "") & (moa != "None")
    out = joined(joined(joined(base, reversed_, "pert_iname", "left"), pivot, "pert_iname", "left"), papers, "pert_iname", "left")
    out = (out.select("pert_iname",
                   (F.col("max_potency") >= F.lit(float(min_potency))).alias("high_potency"),
                   (F.col("affected_genes") <= max_genes).alias("high_specificity"),
                   (~_is_unknown() | known_moa).alias("moa_clarity"),
                   (F.col("extreme_genes") <= max_extreme_genes).alias("limited_extreme"),
                   F.coalesce(F.col("__rev"), F.lit(False)).alias("reversal_match"),
                   F.coalesce(F.abs(F.col("Gene_Delta")) < shift, F.lit(False)).alias("stable_over_time"),
                   (F.coalesce(F.col("pubmed_papers"), F.lit(0)) < novelty).alias("novel_literature")))
    return out.withColumn("criteria_met", sum(F.col(c).cast("int") for c in CRITERIA))
