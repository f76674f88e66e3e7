"""Sides of joins that take little room in files and much as rows are not sent to the driver."""

import tempfile

import pytest
from pyspark.sql import functions as F

from sigspark.operators import sides
from tests.test_skew import _plan

N = 400_000


def _landed(df):
    path = tempfile.mkdtemp(prefix="sigspark-test-") + "/t"
    df.coalesce(1).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _name(prefix, col="id"):
    return F.concat(F.lit(prefix), F.lpad(F.col(col).cast("string"), 9, "0"))


@pytest.fixture(scope="module")
def grown(spark):
    ids = spark.range(N)
    return {
        "part": _landed(ids.select(F.col("id").alias("p_partkey"), F.lit("B").alias("p_brand"), F.lit("T").alias("p_type"), F.lit(9).alias("p_size"))),
        "supplier": _landed(ids.select(F.col("id").alias("s_suppkey"), _name("Supplier#").alias("s_name"), (F.col("id") % 25).cast("int").alias("s_nationkey"))),
        "sig_info": _landed(ids.select(_name("s").alias("sig_id"), _name("c").alias("pert_iname"), F.lit("trt_cp").alias("pert_type"), F.lit("MCF7").alias("cell_id"),
                                       F.lit(10.0).alias("pert_dose"), F.lit("µM").alias("pert_dose_unit"), F.lit("6 h").alias("pert_itime"))),
        "cm": _landed(ids.select(_name("c").alias("pert_iname"), *[F.lit("x").alias(c) for c in ("moa", "target", "canonical_smiles", "pubchem_cid")])),
        "gs": _landed(ids.select(_name("c").alias("pert_iname"), _name("s").alias("sig_id"), F.concat(F.lit("g"), (F.col("id") % 7).cast("string")).alias("pr_gene_symbol"),
                                 (F.col("id") % 19 - 9).cast("double").alias("z_score"), F.lit(1).alias("is_significant"))),
    }


def test_a_side_is_judged_by_its_files_and_the_threshold(spark, grown):
    part = grown["part"]
    assert sides._grown(part) and not sides._grown(part.limit(5)) and not sides._grown(part, part.limit(5))
    assert not sides._grown(spark.range(10**9))  # Spark shuffles it first and measures it as rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not sides._grown(part)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_landing_sends_no_grown_side(spark, grown, monkeypatch):
    from sigspark.sources import binding as Bd

    lines = [(o, p, s, st, q) for o in (1, 2, None) for p in (1, 2, N + 7, None) for s in (1, 2, 30, N + 9, None) for st, q in (("F", 50.0), ("O", 1.0), (None, 3.0))]
    tables = grown | {"lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linestatus string, l_quantity double")}
    monkeypatch.setattr(Bd, "read_table", lambda spark, sf_dir, name: tables[name])
    inputs = Bd.bind_inputs(spark, "any")
    for name in ("sig_info", "matrix_long"):
        assert "BroadcastHashJoin" not in _plan(inputs[name])
    few = {k: F.broadcast(tables[k].where(F.col(c) < 40)) for k, c in (("part", "p_partkey"), ("supplier", "s_suppkey"))}
    keys = spark.sql(Bd.COMPOUND_KEY_SQL, supplier=few["supplier"])
    assay = spark.sql(Bd.ASSAY_SQL, lineitem=tables["lineitem"], part=few["part"], compound_key=keys)
    for name, sql in (("sig_info", Bd.SIG_INFO_SQL), ("matrix_long", Bd.MATRIX_LONG_SQL)):
        want = sorted(map(str, spark.sql(sql, assay=assay).collect()))
        assert want and sorted(map(str, inputs[name].collect())) == want


def test_phase_1_sends_no_signature_list(spark, grown):
    from sigspark.plans.jobs import build_signatures

    genes = _landed(spark.createDataFrame([("g:1", "G1", 1), ("g:2", "G2", 0)], "pr_gene_id string, pr_gene_symbol string, pr_is_lm int"))
    matrix = _landed(spark.range(2 * N).select(F.when(F.col("id") % 2 == 0, "g:1").otherwise("g:2").alias("gene_id"), _name("s").alias("sig_id"), F.lit(3.0).alias("z_score")))
    names = grown["cm"].select("pert_iname", "canonical_smiles", "pubchem_cid"), grown["cm"].select("pert_iname", "moa", "target")
    out = build_signatures({"gene_info": genes, "sig_info": grown["sig_info"], "matrix_long": matrix, "pert_info": names[0], "repurposing": names[1]})
    for df in (out.genetic_signatures, out.compound_metadata):
        plan = _plan(df)
        assert plan.count("BroadcastHashJoin") == 1  # the gene list's
        assert df.count() == N // 2


def test_a_submatrix_is_cut_out_without_sending_the_signatures(spark, grown):
    from sigspark.operators.reshape import extract_submatrix

    genes = _landed(spark.createDataFrame([("g:1",), ("g:1",), (None,)], "pr_gene_id string"))
    cells = [("g:1", f"s{7:09d}", 1.0), ("g:1", f"s{7:09d}", 1.0), ("g:2", f"s{7:09d}", 2.0), ("g:1", f"s{N:09d}", 3.0), (None, f"s{1:09d}", 4.0), ("g:1", None, 5.0)]
    out = extract_submatrix(spark.createDataFrame(cells, "gene_id string, sig_id string, z_score double"), genes, grown["sig_info"].unionByName(grown["sig_info"]))
    assert _plan(out).count("BroadcastHashJoin") == 1  # the gene list's
    assert sorted(map(tuple, out.select("gene_id", "sig_id", "z_score").collect())) == cells[:2]


def test_an_append_sends_no_stored_keys(spark, scratch):
    from sigspark.sources import keyed as K

    rows = spark.range(N).select(_name("k").alias("k"), F.col("id").alias("v")).unionByName(spark.createDataFrame([(None, 1)], "k string, v long"))
    assert K.append_rows(rows, f"{scratch}/t", ["k"]) == N + 1
    again = rows.where(F.col("v") < 5).unionByName(spark.createDataFrame([("new", 8), ("new", 3), (None, 9)], "k string, v long"))
    absent = K.absent_rows(again, f"{scratch}/t", ["k"])
    assert "BroadcastHashJoin" not in _plan(absent)
    assert [tuple(r) for r in absent.collect()] == [("new", 3)]


def test_papers_are_counted_without_sending_the_index_or_the_compounds(spark, grown):
    from sigspark.plans import literature as Lit
    from sigspark.plans import questions as E

    index = _landed(spark.range(N).select(_name("t").alias("token"), F.lit(3).cast("long").alias("n_docs")))
    counts = Lit.literature_counts(index, spark.createDataFrame([(f"T{5:09d}",), (f"T{5:09d}",), ("none",), (None,)], "term string"))
    leads = E.lead_candidates(grown["cm"], grown["gs"], max_genes=50, min_potency=9.0)
    for df in (counts, leads):
        assert "BroadcastHashJoin" not in _plan(df)
    assert sorted(map(str, map(tuple, counts.collect()))) == sorted(map(str, [(f"T{5:09d}", 3), (f"T{5:09d}", 3), ("none", 0), (None, 0)]))
    assert leads.count() == sum(abs(i % 19 - 9) == 9 for i in range(N))


def test_the_phases_send_no_grown_side(spark, grown):
    from sigspark.operators import joins as C
    from sigspark.operators import quality as D
    from sigspark.plans import profiles as H
    from sigspark.plans import questions as E
    from sigspark.plans import temporal as G

    cm, gs, sig_info = grown["cm"], grown["gs"], grown["sig_info"]
    for df in (C.orphaned_signatures(gs, cm), C.attach_compound(gs.drop("pert_iname"), sig_info), D.compound_profile_summary(cm, gs), E.precision_vs_power(cm, gs),
               E.drug_type_counts(cm, gs), E.toxicity_extreme_hits(cm, gs), G.response_features(cm, gs), G.time_metrics(gs, sig_info), G.late_new_hits(gs, sig_info),
               H.predict_response(gs, cm)):
        assert "BroadcastHashJoin" not in _plan(df)
    assert D.compound_profile_summary(cm, gs).where("total_affected_genes = 1").count() == N
    assert C.orphaned_signatures(gs, cm).count() == 0
