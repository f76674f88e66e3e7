"""Micro-fixtures for the semantic traps (FIXTURES.md §4) and invariants."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sigspark import config
from sigspark.functions.columns import (clinical_triage, compound_category, format_percentage, format_scientific,
                                        novelty_status, profile_rule, research_maturity, risk_level)
from sigspark.operators import joins as C
from sigspark.operators import quality as D
from sigspark.operators import reshape as B
from sigspark.operators.stats import exact_quantiles, sequence_index
from sigspark.plans import questions as E


def _col(df, name):
    return [r[name] for r in df.collect()]


def test_triage_documented_cases(spark):
    df = spark.createDataFrame([(11, 40), (34, 15), (20, 25), (20, 20), (20, None)], "g6 long, g24 long")
    out = df.select(clinical_triage("g6", F.col("g24") - F.col("g6")).alias("p"))
    assert _col(out, "p") == [config.TRIAGE_CASCADE, config.TRIAGE_RAPID, config.TRIAGE_GRADUAL,
                              config.TRIAGE_SUSTAINED, config.TRIAGE_SUSTAINED]


def test_threshold_edges(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", -2.0), ("c", 1.999)], "pr_gene_symbol string, z_score double")
    assert sorted(_col(B.filter_by_z_score(df), "pr_gene_symbol")) == ["a", "b"]
    assert _col(E.master_regulators(df), "pr_gene_symbol") == []  # E5 is strict: > 2


def test_profile_edges(spark):
    df = spark.createDataFrame([(8.0, 50), (8.0, 51), (3.0, 1), (2.99, 1), (None, 0)], "p double, g long")
    assert _col(df.select(profile_rule("p", "g").alias("x")), "x") == [
        "Precision_Lead", "Broad_Spectrum", "Moderate_Impact", "Low_Activity", "Unknown"]


def test_moa_category(spark):
    df = spark.createDataFrame([(None,), ("",), ("None",), ("HDAC inhibitor",), ("receptor antagonist",),
                                ("x blocker",)], "moa string")
    assert _col(df.select(compound_category("moa").alias("c")), "c") == [
        "Novel Mechanism"] * 3 + ["Targeted Suppressor", "Pathway Activator", "Complex Regulator"]


def test_novelty_and_risk_edges(spark):
    df = spark.createDataFrame([(4,), (5,), (10,), (11,), (50,), (51,), (-1,)], "n long")
    out = df.select(novelty_status("n").alias("s"), risk_level("n").alias("r"))
    assert _col(out, "s") == ["novel"] + ["established"] * 5 + ["error"]
    assert _col(out, "r")[:6] == ["HIGH", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW"]


def test_maturity_edges(spark):
    df = spark.createDataFrame([(0,), (1,), (100,), (101,), (None,)], "n long")
    assert _col(df.select(research_maturity("n").alias("m")), "m") == [
        "Novel IP (Unpatented)", "Emerging", "Emerging", "Highly Established", "Error"]


def test_null_key_merge_matches_nulls(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v long")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, v long")
    out = C.merge(left, right, ["k"], "inner")
    assert out.columns == ["k", "v_x", "v_y"]
    assert sorted(out.collect(), key=lambda r: r["v_x"]) == [(None, 1, 10), ("a", 2, 20)]
    outer = C.merge(left, spark.createDataFrame([("b", 5)], "k string, v long"), ["k"], "outer")
    assert sorted(_col(outer, "k"), key=str) == [None, "a", "b"]


def test_melt_keeps_nulls_stack_drops_them(spark):
    df = spark.createDataFrame([("x", 1.0, None)], "id string, g1 double, g2 double")
    assert B.melt_wide_to_long(df, ["id"]).count() == 2
    assert B.stack_matrix(df, ["id"]).count() == 1
    with pytest.raises(Exception):
        B.melt_wide_to_long(df, ["missing"])


def test_moments_match_pandas(spark):
    vals = [1, 2, 3, 4, 10, 7, 3.5]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(3)
    row = D.column_statistics(df, "x").collect()[0]
    s = pd.Series(vals)
    assert row["skewness"] == pytest.approx(1.1079430470, abs=1e-6)
    assert row["kurtosis"] == pytest.approx(0.6407449411, abs=1e-6)
    assert row["std"] == pytest.approx(3.1186840937, abs=1e-6)
    assert row["q1"] == pytest.approx(2.5)
    assert row["median"] == pytest.approx(s.median())
    assert row["q3"] == pytest.approx(s.quantile(0.75))


def test_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "z_score double")
    for method in ("standard", "minmax", "robust"):
        assert _col(D.normalize(df, "z_score", method), "z_score_normalized") == [None] * 3
    assert not any(_col(D.outliers_zscore(df, "z_score"), "is_outlier"))
    assert not any(_col(D.outliers_iqr(df, "z_score"), "is_outlier"))


def test_dedupe_keep(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, o long")
    assert sorted(B.dedupe(df, ["k"], ["o"], "first").collect()) == [("a", 1), ("b", 3)]
    assert sorted(B.dedupe(df, ["k"], ["o"], "last").collect()) == [("a", 2), ("b", 3)]
    assert B.dedupe(df, ["k"], ["o"], False).collect() == [("b", 3)]


def test_not_in_with_null(spark):
    gs = spark.createDataFrame([("zz", "s", "g", 3.0, 1)],
                               "pert_iname string, sig_id string, pr_gene_symbol string, z_score double, "
                               "is_significant int")
    cm = spark.createDataFrame([("a",), (None,)], "pert_iname string")
    assert C.orphaned_signatures(gs, cm).count() == 0
    assert C.orphaned_signatures(gs, cm, null_aware=False).count() == 1


def test_bad_number(spark):
    df = spark.createDataFrame([("abc",), ("1.5",)], "v string")
    assert _col(df.select(B.coerce_numeric("v").alias("x")), "x") == [None, 1.5]
    with pytest.raises(Exception):
        B.safe_cast(df, "v", "double").collect()


def test_signed_moa_fingerprint(spark):
    cm = spark.createDataFrame([("ref", "m"), ("other", "m")], "pert_iname string, moa string")
    gs = spark.createDataFrame([("ref", "s1", "g1", -5.0), ("other", "s2", "g1", 5.0),
                                ("ref", "s1", "g2", 4.0), ("other", "s2", "g2", 4.0)],
                               "pert_iname string, sig_id string, pr_gene_symbol string, z_score double")
    out = E.moa_mimics(cm, gs, reference="ref").collect()
    assert [(r["pert_iname"], r["matching_gene_count"]) for r in out] == [("other", 1)]


def test_format_functions(spark):
    df = spark.createDataFrame([(123456.0, 0.1234)], "v double, p double")
    row = df.select(format_scientific("v", 2).alias("s"), format_percentage("p", 1).alias("q")).collect()[0]
    assert (row["s"], row["q"]) == ("1.23e+05", "12.3%")


def test_sequence_index_is_dense_and_ordered(spark):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=2000)
    df = spark.createDataFrame(pd.DataFrame({"v": vals})).repartition(7)
    out = sequence_index(df, ["v"], "i").toPandas().sort_values("i")
    assert list(out["i"]) == list(range(2000))
    assert np.all(np.diff(out["v"].to_numpy()) >= 0)


def test_exact_quantiles_grouped_vs_numpy(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 3000), "v": rng.exponential(size=3000)})
    pdf.loc[pdf["g"] == 0, "g"] = 0  # group 0 is the hot group
    pdf.loc[:1500, "g"] = 0
    df = spark.createDataFrame(pdf).repartition(5)
    got = exact_quantiles(df, "v", [0.1, 0.5, 0.9], ["g"], ["a", "b", "c"]).toPandas().set_index("g").sort_index()
    for g, grp in pdf.groupby("g"):
        want = np.percentile(grp["v"], [10, 50, 90])
        assert got.loc[g, ["a", "b", "c"]].to_numpy() == pytest.approx(want, rel=1e-12)


def _brute_transfer(pairs, threshold_rows):
    unknown = {p for p, _ in pairs if p.upper().startswith("BRD-")}
    known = {p for p, _ in pairs} - unknown
    genes = {}
    for p, g in pairs:
        genes.setdefault(p, set()).add(g)
    best = {}
    for u in unknown:
        cands = [(-len(genes[u] & genes[k]), k) for k in known if genes[u] & genes[k]]
        if cands:
            c, k = min(cands)
            best[u] = (k, -c)
    return best


def test_moa_transfer_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(11)
    names = [f"BRD-{i:03d}" for i in range(25)] + [f"drug{i:03d}" for i in range(30)] + ["brd-low"]
    rows = []
    for n in names:
        for g in rng.choice(40, size=rng.integers(1, 12), replace=False):
            rows.append((n, f"s-{n}", f"G{g}", 5.0))
        rows.append((n, f"s-{n}", "HOT", 5.0))  # one gene shared by every compound
    gs = spark.createDataFrame(rows, "pert_iname string, sig_id string, pr_gene_symbol string, z_score double")
    cm = spark.createDataFrame([(n, f"moa-{n}") for n in names], "pert_iname string, moa string")
    pairs = sorted({(p, g) for p, _, g, _ in rows})
    want = _brute_transfer(pairs, 3.0)
    for block in (4, 1024):  # many blocks and a single block
        got = {r["pert_iname"]: (r["best_match"], r["shared_genes"])
               for r in E.moa_transfer(cm, gs, block_size=block).collect()}
        assert got == want
    assert all(got[u][0].startswith("drug") for u in got)


def test_read_matrix_tsv_keeps_missing_cells(spark, scratch):
    path = f"{scratch}/m.tsv"
    with open(path, "w") as fh:
        fh.write("rid\ts1\ts2\n")
        fh.write("g1\t1.5\t\n")
        fh.write("g2\tNaN\t-2\n")
    from sigspark.sources.readers import read_matrix_tsv

    out = {(r["rid"], r["sid"]): r["z"] for r in read_matrix_tsv(spark, path, "rid", "sid", "z").collect()}
    assert out == {("g1", "s1"): 1.5, ("g1", "s2"): None, ("g2", "s1"): None, ("g2", "s2"): -2.0}


def test_append_is_idempotent(spark, scratch):
    from sigspark.sources.sinks import append_new_signatures

    df = spark.createDataFrame([("a", "s", "g", 2.5), ("a", "s", "g", 2.5), ("b", "s", "g", 1.0)],
                               "pert_iname string, sig_id string, pr_gene_symbol string, z_score double")
    path = f"{scratch}/sig"
    assert append_new_signatures(df, path) == 2
    assert append_new_signatures(df, path) == 0
    got = sorted(spark.read.parquet(path).select("pert_iname", "is_significant").collect())
    assert got == [("a", 1), ("b", 0)]


def test_stream_append_replays_nothing_twice(spark, scratch):
    from sigspark.streaming.append import stream_append_signatures

    df = spark.createDataFrame([(f"c{i}", f"s{i}", "g", float(i)) for i in range(10)],
                               "pert_iname string, sig_id string, pr_gene_symbol string, z_score double")
    df.repartition(3).write.parquet(f"{scratch}/in")
    out = stream_append_signatures(spark, f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck", max_files_per_trigger=1)
    assert out.count() == 10
    df.write.mode("append").parquet(f"{scratch}/in")  # the same rows arrive again
    assert stream_append_signatures(spark, f"{scratch}/in", f"{scratch}/t", f"{scratch}/ck").count() == 10


def test_classification_metrics_match_sklearn_formulas(spark):
    t = ["a", "a", "b", "b", "c"]
    p = ["a", "b", "b", "b", "a"]
    df = spark.createDataFrame(list(zip(t, p)), "rule_profile string, clinical_profile string")
    from sigspark.plans.profiles import classification_metrics

    row = classification_metrics(df).collect()[0]
    # hand-computed: precision a=1/2 b=2/3 c=0; recall a=1/2 b=1 c=0; support 2,2,1
    assert row["accuracy"] == pytest.approx(0.6)
    assert row["precision_weighted"] == pytest.approx(round((2 * 0.5 + 2 * 2 / 3) / 5, 6))
    assert row["recall_weighted"] == pytest.approx(0.6)
    f1 = (2 * (2 * 0.5 * 0.5 / 1.0) + 2 * (2 * (2 / 3) * 1 / (2 / 3 + 1))) / 5
    assert row["f1_weighted"] == pytest.approx(round(f1, 6))
    assert not math.isnan(row["f1_weighted"])


def test_matrix_tsv_round_trip_with_missing_cell(spark, scratch):
    from sigspark.sources.readers import read_matrix_tsv
    from sigspark.sources.sinks import write_matrix_tsv

    long = spark.createDataFrame([("s1", "gA", 1.25), ("s1", "gB", -3.0), ("s2", "gB", 1e-4)],
                                 "sig_id string, gene_id string, z_score double")
    path = write_matrix_tsv(long, f"{scratch}/wide")
    back = {(r["sig_id"], r["gene_id"]): r["z_score"] for r in read_matrix_tsv(spark, path, "sig_id", "gene_id").collect()}
    assert back == {("s1", "gA"): 1.25, ("s1", "gB"): -3.0, ("s2", "gA"): None, ("s2", "gB"): 1e-4}


def test_batch_map_slices_rows(spark):
    from sigspark.functions.batch import batch_map

    df = spark.range(0, 1000, numPartitions=2).selectExpr("id", "cast(id as double) as z_score")

    def tag(pdf):
        return pdf.assign(n=len(pdf))[["id", "n"]]

    out = batch_map(df, tag, "id long, n long", batch_size=64).toPandas()
    assert len(out) == 1000 and out["n"].max() <= 64


def test_registry_unknown_name_and_missing_inputs(spark, scratch):
    from sigspark import ValidationError
    from sigspark.plans.registry import run_business_query
    from sigspark.sources.readers import require_inputs

    with pytest.raises(ValidationError):
        run_business_query(spark, "no_such_question", "/root/testdata/sf0.001")
    with pytest.raises(ValidationError):
        require_inputs(spark, ["/root/testdata/sf0.001/lineitem.parquet", f"{scratch}/absent.tsv.gz"])
    require_inputs(spark, ["/root/testdata/sf0.001/lineitem.parquet"])


def test_matrix_arrays_round_trip_keeps_null_cells(spark, scratch):
    from sigspark.sources.readers import read_matrix_arrays
    from sigspark.sources.sinks import write_matrix_arrays

    long = spark.createDataFrame([("s1", "gA", 1.25), ("s1", "gB", -3.0), ("s2", "gB", 1e-4)],
                                 "sig_id string, gene_id string, z_score double")
    path = write_matrix_arrays(long, f"{scratch}/arrays")
    back = {(r["sig_id"], r["gene_id"]): r["z_score"] for r in read_matrix_arrays(spark, path).collect()}
    assert back == {("s1", "gA"): 1.25, ("s1", "gB"): -3.0, ("s2", "gA"): None, ("s2", "gB"): 1e-4}


def test_safe_cast_is_strict_without_ansi(spark):
    df = spark.createDataFrame([("abc",), ("1.5",)], "v string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception):
            B.safe_cast(df, "v", "double").collect()
        assert _col(B.safe_cast(df.where("v = '1.5'"), "v", "double"), "v") == [1.5]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
