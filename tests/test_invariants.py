"""Structural invariants on the bound fixture tables."""

from pyspark.sql import functions as F

from sigspark.operators import joins as C
from sigspark.operators import reshape as B
from sigspark.plans import profiles as H
from sigspark.plans import questions as E
from sigspark.plans import temporal as G
from sigspark.sources.store import signature_tables


def _tables(spark, sf_dir):
    return signature_tables(spark, sf_dir)


def test_semi_and_anti_partition_the_signatures(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cm, gs = t["compound_metadata"], t["genetic_signatures"]
    semi = gs.join(cm.select("pert_iname"), "pert_iname", "left_semi").count()
    anti = C.orphaned_signatures(gs, cm, null_aware=False).count()
    assert semi + anti == gs.count()
    assert anti == C.orphaned_signatures(gs, cm).count()  # keys are non-null, so NOT IN = left_anti


def test_pivot_then_unpivot_is_identity(spark, sf_dir):
    t = _tables(spark, sf_dir)
    metrics = G.time_metrics(t["genetic_signatures"], t["sig_info"])
    wide = G.time_pivot_delta(metrics).select("pert_iname", "Max_Potency_6h", "Max_Potency_24h")
    back = B.stack_matrix(wide, ["pert_iname"], None, "time_point", "max_potency").select(
        "pert_iname", F.regexp_replace(F.regexp_extract("time_point", "_([0-9]+h)$", 1), "h$", " h").alias("pert_itime"),
        "max_potency")
    assert sorted(back.collect()) == sorted(metrics.select("pert_iname", "pert_itime", "max_potency").collect())


def test_profile_classes_partition_the_compounds(spark, sf_dir):
    t = _tables(spark, sf_dir)
    feats = G.response_features(t["compound_metadata"], t["genetic_signatures"])
    prof = H.profile_rules(feats)
    assert prof.select("pert_iname").distinct().count() == feats.count() == prof.count()
    assert prof.where(F.col("clinical_profile").isNull()).count() == 0


def test_leads_and_final_matrix_are_subsets(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cm, gs = t["compound_metadata"], t["genetic_signatures"]
    leads = E.precision_leads(cm, gs)
    candidates = E.lead_candidates(cm, gs)
    assert leads.join(candidates, "pert_iname", "left_anti").count() == 0
    fm = E.final_matrix(cm, gs)
    assert fm.select("pert_iname").distinct().join(leads, "pert_iname", "left_anti").count() == 0
    assert fm.select("pr_gene_symbol").distinct().count() <= 7


def test_phase1_rebuild_equals_landed_tables(spark, sf_dir):
    from sigspark.plans.jobs import build_signatures
    from sigspark.sources.store import INPUT_TABLES

    t = _tables(spark, sf_dir)
    rebuilt = build_signatures({k: t[k] for k in INPUT_TABLES})
    assert rebuilt.genetic_signatures.exceptAll(t["genetic_signatures"]).count() == 0
    assert t["genetic_signatures"].exceptAll(rebuilt.genetic_signatures).count() == 0
    assert rebuilt.compound_metadata.count() == t["compound_metadata"].count()
