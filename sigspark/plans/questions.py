"""The business questions (inventory E0–E11).

Inputs are ``cm`` (compound metadata, keyed by ``pert_iname``) and ``gs``
(significant signature rows). Plan shape used throughout:

* aggregate ``gs`` per compound first (partial aggregation map-side, so a
  compound holding a third of all rows is combined before the shuffle),
  then join the per-compound result with ``cm``; because ``cm`` is keyed by
  ``pert_iname`` this equals the reference's join-then-group;
* ``COUNT(DISTINCT gene)`` is Spark's two-level distinct aggregate
  (shuffle on compound+gene, then compound), so it is skew-safe too;
* every top-k appends the name ascending as a tie-breaker and is a
  ``TakeOrderedAndProject`` (per-partition top-k, bounded merge);
* a top-k list that feeds a later join is broadcast — its size is bounded
  by k.

Floating averages are rounded to 6 decimals before ordering (both engines
add in different orders).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark import config
from sigspark.functions.columns import compound_category, gene_function
from sigspark.functions.literals import literal_rows
from sigspark.operators.joins import fact_dim_join
from sigspark.operators.partners import best_partners
from sigspark.operators.reshape import number, z_above, z_beyond
from sigspark.operators.sides import joined
from sigspark.operators.stats import exact_quantiles, landed, with_scalars


def _abs_z() -> Column:
    """``abs(z)``; NaN, which Spark orders above every number, is missing."""
    return F.abs(F.nanvl(F.col("z_score"), F.lit(None).cast("double")))


def _r6(c: Column) -> Column:
    return F.round(c, 6)


def _is_unknown(name: Column | str = "pert_iname", prefix: str = config.UNKNOWN_PREFIX) -> Column:
    """SQLite ``LIKE 'BRD-%'`` is ASCII case-insensitive, hence ``ilike``."""
    name = F.col(name) if isinstance(name, str) else name
    return name.ilike(prefix.replace("%", "\\%").replace("_", "\\_") + "%")


def _with_metadata(per_compound: DataFrame, cm: DataFrame, cols: Sequence[str]) -> DataFrame:
    return joined(per_compound, cm.select("pert_iname", *cols), "pert_iname")


# E0a
def strongest_hits(cm: DataFrame, gs: DataFrame, n: int = 5) -> DataFrame:
    rows = gs.select("pert_iname", "sig_id", "pr_gene_symbol", number(gs, "z_score").alias("z_score"))
    j = fact_dim_join(cm.select("pert_iname", "moa"), rows)
    return (j.orderBy(F.col("z_score").desc(), "pert_iname", "pr_gene_symbol", "sig_id").limit(n)
            .select("pert_iname", "moa", "pr_gene_symbol", "z_score"))


# E0b
def single_target_up(cm: DataFrame, gs: DataFrame, gene: str = config.SINGLE_TARGET_GENE, threshold: float = config.Z_THRESHOLD,
                     n: int = 10) -> DataFrame:
    rows = gs.where((F.col("pr_gene_symbol") == gene) & z_above(threshold))
    j = joined(rows, cm.select("pert_iname"), "pert_iname", "left_semi")
    return j.orderBy(F.col("z_score").desc(), "pert_iname", "sig_id").limit(n).select("pert_iname", "z_score")


# E1
def reversal_signature(cm: DataFrame, gs: DataFrame, genes: Sequence[str] = config.REVERSAL_GENES,
                       threshold: float = config.Z_THRESHOLD, n: int = 10) -> DataFrame:
    rows = gs.where(F.col("pr_gene_symbol").isin(list(genes)) & z_above(threshold))
    per = (rows.groupBy("pert_iname")
           .agg(F.avg("z_score").alias("avg_impact"), F.countDistinct("pr_gene_symbol").alias("_genes"))
           .where(F.col("_genes") == len(set(genes))))
    j = joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")
    return (j.select("pert_iname", _r6(F.col("avg_impact")).alias("avg_impact"))
            .orderBy(F.col("avg_impact").desc(), "pert_iname").limit(n))


# E1g
def reversal_general(cm: DataFrame, gs: DataFrame, disease: DataFrame,
                     threshold: float = config.Z_THRESHOLD) -> DataFrame:
    """Compounds that move every disease gene the opposite way beyond ``threshold``.

    ``disease`` is ``(pr_gene_symbol, direction)`` with direction +1 (up in
    disease) or -1. Score = mean of ``-direction * z`` over the matching rows.
    The disease table is a gene list (bounded by the gene universe).
    """
    d = disease.select("pr_gene_symbol", F.col("direction").cast("double").alias("direction"))
    n_genes = d.select("pr_gene_symbol").distinct().agg(F.count(F.lit(1)).alias("_n_disease"))
    hits = (gs.join(d, "pr_gene_symbol", "inner")
            .where((-F.col("direction") * F.col("z_score") > F.lit(float(threshold))) & ~F.isnan("z_score")))
    per = (hits.groupBy("pert_iname")
           .agg(F.countDistinct("pr_gene_symbol").alias("genes_reversed"),
                F.avg(-F.col("direction") * F.col("z_score")).alias("reversal_score")))
    per = per.join(F.broadcast(n_genes), F.col("genes_reversed") == F.col("_n_disease"), "inner")
    j = joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")
    return j.select("pert_iname", "genes_reversed", _r6(F.col("reversal_score")).alias("reversal_score"))


# E2
def moa_mimics(cm: DataFrame, gs: DataFrame, reference: str = config.REFERENCE_COMPOUND,
               threshold: float = config.HIGH_CONFIDENCE_Z, n: int = 10) -> DataFrame:
    strong = gs.where(z_above(threshold))
    ref_genes = strong.where(F.col("pert_iname") == reference).select("pr_gene_symbol").distinct()
    rows = strong.where(F.col("pert_iname") != reference).join(ref_genes, "pr_gene_symbol", "left_semi")
    per = rows.groupBy("pert_iname").agg(F.count(F.lit(1)).alias("matching_gene_count"))
    return (_with_metadata(per, cm, ["moa"]).select("pert_iname", "moa", "matching_gene_count")
            .orderBy(F.col("matching_gene_count").desc(), "pert_iname").limit(n))


# E3
def toxicity_extreme_hits(cm: DataFrame, gs: DataFrame, threshold: float = config.EXTREME_Z, n: int = 20) -> DataFrame:
    per = (gs.where(z_beyond(threshold, strict=True)).groupBy("pert_iname")
           .agg(F.count(F.lit(1)).alias("extreme_hit_count")))
    return (joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")
            .orderBy(F.col("extreme_hit_count").desc(), "pert_iname").limit(n))


# E3b
def safety_profile(cm: DataFrame, gs: DataFrame, compound: str = config.REFERENCE_COMPOUND,
                   threshold: float = config.Z_THRESHOLD) -> DataFrame:
    rows = gs.where((F.col("pert_iname") == compound) & z_beyond(threshold))
    rows = rows.join(cm.where(F.col("pert_iname") == compound).select("pert_iname"), "pert_iname", "left_semi")
    return rows.orderBy(F.col("z_score").desc(), "pr_gene_symbol").select("pr_gene_symbol", "z_score")


# E3c
def risk_filter(cm: DataFrame, gs: DataFrame, max_extreme_genes: int = config.RISK_MAX_EXTREME_GENES,
                extreme: float = config.EXTREME_Z, risk_genes: DataFrame | None = None,
                threshold: float = config.Z_THRESHOLD) -> DataFrame:
    """Compounds that survive: ≤ ``max_extreme_genes`` genes at |Z| > extreme and
    no significant hit on a gene of ``risk_genes`` (a gene list)."""
    per = (gs.groupBy("pert_iname")
           .agg(F.countDistinct(F.when(z_beyond(extreme, strict=True), F.col("pr_gene_symbol"))).alias("extreme_genes")))
    kept = per.where(F.col("extreme_genes") <= max_extreme_genes)
    if risk_genes is not None:
        flagged = (gs.where(z_beyond(threshold))
                   .join(risk_genes.select("pr_gene_symbol"), "pr_gene_symbol", "left_semi").select("pert_iname").distinct())
        kept = joined(kept, flagged, "pert_iname", "left_anti")
    return _with_metadata(kept, cm, ["moa"]).select("pert_iname", "moa", "extreme_genes")


# E4
def potency_benchmark(cm: DataFrame, gs: DataFrame, n: int = 10) -> DataFrame:
    per = gs.groupBy("pert_iname").agg(F.max(_abs_z()).alias("max_potency"))
    return (_with_metadata(per, cm, ["moa"]).select("pert_iname", "moa", "max_potency")
            .orderBy(F.col("max_potency").desc(), "pert_iname").limit(n))


# E5
def master_regulators(gs: DataFrame, threshold: float = config.Z_THRESHOLD, n: int = 15) -> DataFrame:
    per = gs.where(z_beyond(threshold, strict=True)).groupBy("pr_gene_symbol").agg(F.count(F.lit(1)).alias("frequency"))
    return per.orderBy(F.col("frequency").desc(), "pr_gene_symbol").limit(n)


# E5b
def master_regulators_by_freq(gs: DataFrame, min_frequency: int = config.MASTER_REGULATOR_FREQ,
                              threshold: float = config.Z_THRESHOLD) -> DataFrame:
    per = gs.where(z_beyond(threshold)).groupBy("pr_gene_symbol").agg(F.count(F.lit(1)).alias("frequency"))
    return per.where(F.col("frequency") > min_frequency)


# E6
def repurposing_efficiency(cm: DataFrame, gs: DataFrame, threshold: float = config.HIGH_CONFIDENCE_Z,
                           n: int = 10) -> DataFrame:
    rows = gs.where(~_is_unknown() & z_beyond(threshold, strict=True))
    per = rows.groupBy("pert_iname").agg(F.countDistinct("pr_gene_symbol").alias("genes_regulated"))
    return (_with_metadata(per, cm, ["moa"]).select("pert_iname", "moa", "genes_regulated")
            .orderBy(F.col("genes_regulated").desc(), "pert_iname").limit(n))


def _drug_type() -> Column:
    return F.when(_is_unknown(), config.DRUG_TYPE_UNKNOWN).otherwise(config.DRUG_TYPE_KNOWN)


# E6b
def drug_type_counts(cm: DataFrame, gs: DataFrame) -> DataFrame:
    per = gs.groupBy("pert_iname").agg(F.count(F.lit(1)).alias("_n"))
    j = joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")
    return j.groupBy(_drug_type().alias("drug_type")).agg(F.sum("_n").cast("long").alias("hit_count"))


# E7
def precision_vs_power(cm: DataFrame, gs: DataFrame) -> DataFrame:
    per = gs.groupBy("pert_iname").agg(F.max(_abs_z()).alias("max_potency"),
                                       F.countDistinct("pr_gene_symbol").alias("affected_genes"))
    return joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")


# E7b
def ideal_zone(cm: DataFrame, gs: DataFrame, max_genes: int = config.MAX_AFFECTED_GENES) -> DataFrame:
    return precision_vs_power(cm, gs).withColumn("in_ideal_zone", F.col("affected_genes").between(0, max_genes))


# E8
def class_validation(cm: DataFrame, gs: DataFrame, genes: Sequence[str] = config.CLASS_MARKER_GENES,
                     min_avg: float = config.EXTREME_Z) -> DataFrame:
    rows = gs.where(F.col("pr_gene_symbol").isin(list(genes)))
    per = (rows.groupBy("pert_iname", "pr_gene_symbol").agg(F.avg(number(rows, "z_score")).alias("_avg"))
           .where(F.col("_avg") > F.lit(float(min_avg))))
    return (_with_metadata(per, cm, ["moa"])
            .select("pert_iname", "moa", "pr_gene_symbol", _r6(F.col("_avg")).alias("avg_z"))
            .orderBy("pert_iname", "pr_gene_symbol"))


# E8b
def class_distribution(cm: DataFrame, gs: DataFrame, genes: Sequence[str] = config.CLASS_MARKER_GENES,
                       members: Sequence[str] = config.CLASS_MEMBERS,
                       min_avg: float = config.EXTREME_Z) -> DataFrame:
    """E8 rows with per-gene quartiles of ``avg_z`` and a class-member flag."""
    qc = landed(class_validation(cm, gs, genes, min_avg))  # read by the counts, the quartiles and the rows
    counts = qc.groupBy("pr_gene_symbol").agg(F.count(F.lit(1)).alias("gene_n"))
    quart = exact_quantiles(qc, "avg_z", [0.25, 0.5, 0.75], ["pr_gene_symbol"], ["__q1", "__q2", "__q3"]).select(
        "pr_gene_symbol", _r6(F.col("__q1")).alias("gene_q1"), _r6(F.col("__q2")).alias("gene_median"),
        _r6(F.col("__q3")).alias("gene_q3"))
    return (qc.join(counts, "pr_gene_symbol", "inner").join(quart, "pr_gene_symbol", "inner")
            .withColumn("is_member", F.col("pert_iname").isin(list(members)))
            .select("pert_iname", "moa", "pr_gene_symbol", "avg_z", "is_member", "gene_n", "gene_q1",
                    "gene_median", "gene_q3"))


def _lead_aggregates(gs: DataFrame) -> DataFrame:
    return gs.groupBy("pert_iname").agg(F.max(_abs_z()).alias("max_potency"),
                                        F.countDistinct("pr_gene_symbol").alias("total_gene_hits"))


def lead_candidates(cm: DataFrame, gs: DataFrame, max_genes: int = config.MAX_AFFECTED_GENES,
                    min_potency: float = config.MIN_POTENCY) -> DataFrame:
    """E9 without the limit: every compound passing both lead rules."""
    per = _lead_aggregates(gs).where((F.col("total_gene_hits") <= max_genes)
                                     & (F.col("max_potency") >= F.lit(float(min_potency))))
    return _with_metadata(per, cm, ["moa", "canonical_smiles", "pubchem_cid"]).select(
        "pert_iname", "moa", "canonical_smiles", "pubchem_cid", "max_potency", "total_gene_hits")


# E9 (flagship)
def precision_leads(cm: DataFrame, gs: DataFrame, max_genes: int = config.MAX_AFFECTED_GENES,
                    min_potency: float = config.MIN_POTENCY, n: int = config.TOP_N_LEADS) -> DataFrame:
    return (lead_candidates(cm, gs, max_genes, min_potency)
            .orderBy(F.col("max_potency").desc(), "pert_iname").limit(n))


def _lead_names(cm, gs, leads: DataFrame | None) -> DataFrame:
    leads = precision_leads(cm, gs) if leads is None else leads
    return F.broadcast(leads.select("pert_iname"))  # bounded by the top-k size


# E9b
def lead_gene_detail(cm: DataFrame, gs: DataFrame, leads: DataFrame | None = None,
                     threshold: float = config.Z_THRESHOLD) -> DataFrame:
    rows = gs.where(z_beyond(threshold)).join(_lead_names(cm, gs, leads), "pert_iname", "inner")
    return (_with_metadata(rows, cm, ["moa"])
            .orderBy("pert_iname", _abs_z().desc(), "pr_gene_symbol", "sig_id")
            .select("pert_iname", "moa", "pr_gene_symbol", "z_score"))


def top_genes(gs: DataFrame, n: int, threshold: float = config.Z_THRESHOLD,
              compounds: DataFrame | None = None) -> DataFrame:
    rows = gs.where(z_beyond(threshold))
    if compounds is not None:
        rows = rows.join(compounds, "pert_iname", "left_semi")
    per = rows.groupBy("pr_gene_symbol").agg(F.count(F.lit(1)).alias("freq"))
    return per.orderBy(F.col("freq").desc(), "pr_gene_symbol").limit(n)


# E9c
def lead_fingerprint(cm: DataFrame, gs: DataFrame, n_genes: int = 20, leads: DataFrame | None = None) -> DataFrame:
    """Mean Z per (lead, gene) over the top genes overall — the heatmap in long form."""
    genes = F.broadcast(top_genes(gs, n_genes).select("pr_gene_symbol"))
    rows = gs.join(_lead_names(cm, gs, leads), "pert_iname", "inner").join(genes, "pr_gene_symbol", "inner")
    per = rows.groupBy("pert_iname", "pr_gene_symbol").agg(F.avg(number(rows, "z_score")).alias("_m"))
    return (joined(per, cm.select("pert_iname"), "pert_iname", "left_semi")
            .select("pert_iname", "pr_gene_symbol", _r6(F.col("_m")).alias("mean_z")))


def _ranked_genes(top: DataFrame) -> DataFrame:
    """A top-k gene list with its rank (a window over k rows)."""
    order = Window.orderBy(F.col("freq").desc(), "pr_gene_symbol")
    return top.select("pr_gene_symbol", F.row_number().over(order).alias("gene_rank"))


def _by_rank(rows: DataFrame, genes: DataFrame, n: int) -> DataFrame:
    """Mean Z per lead with one column per gene rank: ``gene_1`` .. ``gene_n``
    (null where the lead has no row for the gene) and ``gene_1_symbol`` .., the
    names of those genes. The schema depends on ``n`` alone, not on the data."""
    ranks = range(1, n + 1)
    wide = (rows.join(F.broadcast(genes), "pr_gene_symbol", "inner").groupBy("pert_iname", "gene_rank")
            .agg(_r6(F.avg(number(rows, "z_score"))).alias("_m")).groupBy("pert_iname")
            .agg(*[F.max(F.when(F.col("gene_rank") == i, F.col("_m"))).alias(f"gene_{i}") for i in ranks]))
    names = genes.agg(*[F.max(F.when(F.col("gene_rank") == i, F.col("pr_gene_symbol"))).alias(f"gene_{i}_symbol") for i in ranks])
    return with_scalars(wide, names)


def lead_fingerprint_wide(cm: DataFrame, gs: DataFrame, n_genes: int = 20) -> DataFrame:
    """E9c as the heatmap matrix: leads × top genes overall, mean Z, columns by gene rank."""
    rows = gs.join(_lead_names(cm, gs, None), "pert_iname", "inner")
    rows = joined(rows, cm.select("pert_iname"), "pert_iname", "left_semi")
    return _by_rank(rows, _ranked_genes(top_genes(gs, n_genes)), n_genes)


def _final_rows(cm: DataFrame, gs: DataFrame, n_leads: int, n_genes: int) -> DataFrame:
    leads = _lead_names(cm, gs, precision_leads(cm, gs, n=n_leads))
    genes = F.broadcast(top_genes(gs, n_genes, compounds=leads).select("pr_gene_symbol"))
    rows = gs.join(leads, "pert_iname", "inner").join(genes, "pr_gene_symbol", "inner")
    return _with_metadata(rows, cm, ["moa"])


# E10
def final_matrix(cm: DataFrame, gs: DataFrame, n_leads: int = config.TOP_N_LEADS, n_genes: int = 7) -> DataFrame:
    return _final_rows(cm, gs, n_leads, n_genes).select("pert_iname", "moa", "pr_gene_symbol", "z_score")


# E10 (mean pivot, long form)
def final_matrix_mean(cm: DataFrame, gs: DataFrame, n_leads: int = config.TOP_N_LEADS, n_genes: int = 7) -> DataFrame:
    rows = _final_rows(cm, gs, n_leads, n_genes)
    return (rows.groupBy("pert_iname", "moa", "pr_gene_symbol").agg(_r6(F.avg(number(rows, "z_score"))).alias("mean_z")))


def final_matrix_wide(cm: DataFrame, gs: DataFrame, n_leads: int = config.TOP_N_LEADS, n_genes: int = 7) -> DataFrame:
    """E10 / D15 as the reference's matrix: one row per lead, one column per
    rank among the leads' top genes (mean Z, null where the lead has none)."""
    leads = _lead_names(cm, gs, precision_leads(cm, gs, n=n_leads))
    rows = joined(gs.join(leads, "pert_iname", "inner"), cm.select("pert_iname"), "pert_iname", "left_semi")
    return _by_rank(rows, _ranked_genes(top_genes(gs, n_genes, compounds=leads)), n_genes)


# E10b
def compound_categories(cm: DataFrame) -> DataFrame:
    return cm.select("pert_iname", "moa", compound_category("moa").alias("category"))


# E10c
def gene_function_labels(gs: DataFrame) -> DataFrame:
    genes = gs.select("pr_gene_symbol").distinct()
    fn = gene_function("pr_gene_symbol")
    return genes.select("pr_gene_symbol", fn.alias("gene_function"),
                        F.concat(fn, F.lit("\n("), F.col("pr_gene_symbol"), F.lit(")")).alias("gene_label"))


# E2g
def moa_transfer(cm: DataFrame, gs: DataFrame, threshold: float = config.HIGH_CONFIDENCE_Z,
                 block_size: int = 1024, tasks: int | None = None) -> DataFrame:
    """For each unknown (``BRD-``) compound, the known compound sharing the most
    genes at Z > threshold (ties: the smaller name); its mechanism is the
    prediction. The search is ``partners.best_partners``."""
    strong = joined(gs.where(z_above(threshold)), cm.select("pert_iname"), "pert_iname", "left_semi")
    pairs = strong.select("pert_iname", "pr_gene_symbol").distinct().withColumn("known", ~_is_unknown())
    best = best_partners(pairs, block_size, tasks)
    moa = cm.select(F.col("pert_iname").alias("best_match"), F.col("moa").alias("predicted_moa"))
    return joined(best, moa, "best_match", "left").select("pert_iname", "best_match", "shared_genes", "predicted_moa")
