"""Cases for names in texts, missing values, ties, appends, writers, page fields and the phase jobs."""

import math
import time

import pytest
from pyspark.sql import functions as F

from sigspark.errors import ValidationError
from sigspark.operators import joins as C
from sigspark.operators import quality as D
from sigspark.operators import reshape as B
from sigspark.operators.stats import exact_quantiles
from sigspark.plans import literature as Lit
from sigspark.plans import phases
from sigspark.plans import profiles as H
from sigspark.plans import questions as E
from sigspark.plans import temporal as G
from sigspark.plans.registry import QUERIES
from sigspark.session import scratch_root
from sigspark.sources import readers as A
from sigspark.sources import sinks as S
from sigspark.sources import store

NAN = float("nan")


# ---------------------------------------------------------------- literature
def test_names_with_digits_hyphens_blanks_and_accents(spark):
    texts = ["Both MG-132 and brd-k123 were für tested.", "Valproic  Acid, and valproic acid again", "valproic. acid", "MG-132-x", "mg 132", None, "",
             "supplier#000000007 did it", "acid valproic"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = Lit.document_frequency(Lit.postings(docs))
    want = {"MG-132": 1, "BRD-K123": 1, "für": 1, "valproic acid": 2, "Supplier#000000007": 1, "mg": 1, "acid valproic": 1, "absent name": 0, "#": 0}
    terms = spark.createDataFrame([(t,) for t in want], "term string")
    assert {r.term: r.n_docs for r in Lit.literature_counts(index, terms, documents=docs).collect()} == want
    one = terms.where("term in ('MG-132', 'mg')")
    assert {r.term: r.n_docs for r in Lit.literature_counts(index, one).collect()} == {"MG-132": 1, "mg": 1}
    with pytest.raises(Exception, match="several tokens"):
        Lit.literature_counts(index, terms).collect()


def test_phrases_by_positions_match_brute_force(spark, scratch):
    import random

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["a", "b", "c", "the", "the", "D-1"]) for _ in range(rng.randint(0, 30))) for _ in range(200)] + [None, "", "the " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    names = [" ".join(rng.choice(["A", "b", "c", "the", "d-1", "zz"]) for _ in range(rng.randint(1, 4))) for _ in range(80)] + ["the the the", "a  (b)", "", "#"]
    Lit.write_postings(Lit.postings(docs), f"{scratch}/postings")
    landed = spark.read.parquet(f"{scratch}/postings")
    assert "bucket" in landed.columns
    index = Lit.document_frequency(landed)
    terms = spark.createDataFrame([(n,) for n in names], "term string")

    def ids(name):
        key = " ".join(name.lower().replace("(", " ").replace(")", " ").replace("#", " ").split())
        return [i for i, t in enumerate(texts) if key and f" {key} " in f" {' '.join((t or '').lower().split())} "]

    for short in (Lit.SHORT_LIST, 0):
        Lit.SHORT_LIST, before = short, Lit.SHORT_LIST
        try:
            got = {r.term: r.n_docs for r in Lit.literature_counts(index, terms, postings=landed).collect()}
            found = {r.term: (r.publication_count, r.pmids) for r in Lit.literature_search(landed, index, terms, "term").collect()}
        finally:
            Lit.SHORT_LIST = before
        assert got == {n: len(ids(n)) for n in names}
        assert found == {n: (len(ids(n)), ",".join(map(str, ids(n)[:10]))) for n in names}


def test_search_finds_names_whatever_their_case(spark):
    docs = spark.createDataFrame([(1, "Both MG-132 and valproic acid"), (2, "mg-132; acid valproic")], "doc_id long, text string")
    index = Lit.document_frequency(Lit.postings(docs))
    terms = spark.createDataFrame([("MG-132",), ("mg-132",), ("Valproic Acid",), ("none such",)], "compound string")
    got = {r.compound: (r.publication_count, r.pmids) for r in Lit.literature_search(Lit.postings(docs), index, terms).collect()}
    assert got == {"MG-132": (2, "1,2"), "mg-132": (2, "1,2"), "Valproic Acid": (1, "1"), "none such": (0, "")}


def _nan_free(spark, questions):
    """Each question's rows with one NaN score added are those without it."""
    from sigspark import config

    genes = [config.SINGLE_TARGET_GENE, *config.REVERSAL_GENES, *config.CLASS_MARKER_GENES]
    cm = spark.createDataFrame([("a", "m1"), ("b", "m2"), ("BRD-c", "m3"), (config.REFERENCE_COMPOUND, "m4")], "pert_iname string, moa string")
    rows = [(p, f"s{p}", g, z, 1) for p, z in (("a", 5.0), ("b", 4.5), ("BRD-c", 6.0), (config.REFERENCE_COMPOUND, 7.0)) for g in genes]
    schema = "pert_iname string, sig_id string, pr_gene_symbol string, z_score double, is_significant int"
    nan = [(p, "sx", g, NAN, 0) for p in ("a", "z") for g in genes]
    disease = spark.createDataFrame([(g, -1) for g in set(genes)], "pr_gene_symbol string, direction int")
    clean, spoilt = spark.createDataFrame(rows, schema), spark.createDataFrame(rows + nan, schema)
    for ask in questions:
        assert sorted(map(str, ask(cm, spoilt, disease).collect())) == sorted(map(str, ask(cm, clean, disease).collect())) != []


def test_nan_scores_change_no_answer(spark):
    from sigspark.plans import questions as E

    _nan_free(spark, [lambda cm, gs, d, f=f: f(cm, gs) for f in (E.strongest_hits, E.single_target_up, E.reversal_signature, E.moa_mimics, E.class_validation,
                                                                 E.moa_transfer)] + [lambda cm, gs, d: E.reversal_general(cm, gs, d)])


def test_nan_is_missing_in_statistics(spark):
    import math

    from sigspark.operators import quality as Q

    x = spark.createDataFrame([(float(i), "k") for i in range(5)] + [(100.0, "k"), (NAN, "k"), (None, "k")], "z_score double, k string")
    flags = [{r.z_score: r.is_outlier for r in f.collect()} for f in (Q.outliers_zscore(x, "z_score", 2.0), Q.outliers_iqr(x, "z_score"))]
    for found in flags:
        assert [v for k, v in found.items() if k is None or math.isnan(k)] == [False, False] and [k for k, v in found.items() if v] == [100.0]
    assert {r.column: r.null_count for r in Q.null_profile(x).collect()} == {"z_score": 2, "k": 0}
    assert Q.quality_report(x).first().total_nulls == 2 and Q.data_summary(x).first().null_count == 2
    for method in ("standard", "minmax", "robust"):
        got = [r.z_score_normalized for r in Q.normalize(x, "z_score", method).collect()]
        assert sum(v is None for v in got) == 2 and not any(v is not None and math.isnan(v) for v in got)
    rows = spark.createDataFrame([("a", "g", 1.0), ("a", "g", NAN), ("a", "g", 3.0)], "pert_iname string, pr_gene_symbol string, z_score double")
    assert Q.consensus_signature(rows).first().mean_z == 2.0


def test_phase_1_drops_nan_cells(spark):
    from sigspark.plans.jobs import expression_table

    genes = spark.createDataFrame([("1", "g", "1")], "pr_gene_id string, pr_gene_symbol string, pr_is_lm string")
    sigs = spark.createDataFrame([("s", "p", "trt_cp", "MCF7", 10.0, "µM")],
                                 "sig_id string, pert_iname string, pert_type string, cell_id string, pert_dose double, pert_dose_unit string")
    matrix = spark.createDataFrame([("1", "s", NAN), ("1", "s", None)], "gene_id string, sig_id string, z_score double")
    assert expression_table(genes, sigs, matrix).collect() == []


def test_reports_hold_real_counts(spark, sf_dir):
    papers = [r.pubmed_papers for r in QUERIES["executive_report"](spark, sf_dir).collect()]
    assert any(papers)
    larger = sf_dir.replace("sf0.001", "sf0.01")
    assert {r.novel_literature for r in QUERIES["lead_scorecard"](spark, larger).collect()} == {True, False}


def test_page_fields(spark):
    pages = ['<h1 class="heading-title">A <b>bold</b> &amp; new\n title</h1><span class="cit">J. No. 4757 <i>2019</i> Mar</span><div class="article-page">',
             '<h1>Results 9830</h1><span class="value">1,234</span>', "<p>born 1999</p>", None, '<h1>plain <i>x</i> y</h1><h1 class="heading-title">real</h1>',
             '<span class="value">none</span>']
    rows = Lit.page_fields(spark.createDataFrame(list(enumerate(pages)), "page_id long, html string"))
    got = {r.page_id: tuple(r)[1:] for r in rows.collect()}
    assert got[0] == ("A bold & new title", "2019", None, True)
    assert got[1] == ("Results 9830", "N/A", 1234, False)
    assert got[2] == ("N/A", "N/A", None, False) and got[3][:3] == ("N/A", "N/A", None)
    assert got[4][0] == "real" and got[5][2] is None
    maturity = {r.page_id: (r.pubmed_papers, r.research_maturity) for r in Lit.page_maturity(rows.where("page_id < 3")).collect()}
    assert maturity == {0: (1, "Emerging"), 1: (1234, "Highly Established"), 2: (0, "Novel IP (Unpatented)")}


# ---------------------------------------------------------------- missing values
def test_nan_is_missing(spark):
    df = spark.createDataFrame([("a", 1, NAN), ("b", 2, 5.0), ("c", 3, None), ("d", 4, -2.0)], "k string, i int, z_score double")
    got = {r.k: tuple(r)[1:] for r in df.select("k", B.significance_flag("z_score"), B.z_tier("z_score"), B.z_direction("z_score"), B.masked("z_score")).collect()}
    assert got == {"a": (0, "not_significant", "none", None), "b": (1, "extreme", "up", 5.0), "c": (0, "not_significant", "none", None),
                   "d": (1, "not_significant", "down", -2.0)}
    assert {r.k for r in B.filter_by_z_score(df).collect()} == {"b", "d"} == {r.k for r in df.where(B.z_beyond(2.0)).collect()}
    assert {r.k for r in B.stack_matrix(df.select("k", "z_score"), ["k"]).collect()} == {"b", "d"}
    stats = D.column_statistics(df, "z_score").first()
    assert (stats["count"], stats["mean"], stats["max"], stats["median"]) == (2, 1.5, 5.0, 1.5)
    gs = df.select(F.lit("x").alias("pert_iname"), F.col("k").alias("pr_gene_symbol"), "z_score", F.lit(1).alias("is_significant"))
    cm = spark.createDataFrame([("x", None)], "pert_iname string, moa string")
    assert E.potency_benchmark(cm, gs).first().max_potency == 5.0 and G.response_features(cm, gs).first().max_response == 5.0


# ---------------------------------------------------------------- ties and hot keys
def test_quantiles_with_a_third_of_the_rows_equal(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("x"),
                                    (F.col("id") % 2).alias("g"))
    values = sorted(r.x for r in df.collect())
    got = exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0]).first()

    def at(p):
        pos = (len(values) - 1) * p
        lo, hi = values[math.floor(pos)], values[math.ceil(pos)]
        return lo + (hi - lo) * (pos - math.floor(pos))

    assert list(got) == pytest.approx([at(p) for p in (0.0, 0.25, 0.5, 0.9, 1.0)])
    by = {r.g: r.m for r in exact_quantiles(df, "x", [0.5], ["g"], ["m"]).collect()}
    for g in (0, 1):
        values = sorted(r.x for r in df.where(F.col("g") == g).collect())
        assert by[g] == pytest.approx(at(0.5))



def test_semi_join_sides_are_aggregated_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("pert_iname"), "id")
        combined = spark.createDataFrame([("hot", "m", "t", "s", "p"), ("none", "m", "t", "s", "p")],
                                         "pert_iname string, moa string, target string, canonical_smiles string, pubchem_cid string")
        out = C.build_compound_metadata(combined, cells)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate(keys=[pert_iname" in plan
        assert [r.pert_iname for r in out.collect()] == ["hot"]
        ids = B.valid_ids(spark.range(10), cells, "id")
        assert ids.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_moa_transfer_runs_in_several_tasks(spark, sf_dir):
    t = store.signature_tables(spark, sf_dir)
    out = E.moa_transfer(t["compound_metadata"], t["genetic_signatures"])
    one = E.moa_transfer(t["compound_metadata"], t["genetic_signatures"], tasks=1)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, one.collect()))


# ---------------------------------------------------------------- appends and writers
def test_append_keeps_the_first_of_repeated_keys(spark, scratch):
    rows = [("a", "s1", "g", z) for z in (3.0, 1.0, 2.0)] + [("b", "s2", "g", 5.0)]
    for order in (rows, rows[::-1]):
        path = f"{scratch}/{len(order)}-{order[0][3]}"
        df = spark.createDataFrame(order, "pert_iname string, sig_id string, pr_gene_symbol string, z_score double").repartition(3)
        assert S.append_new_signatures(df, path) == 2
        assert {r.sig_id: r.z_score for r in S.stored_table(spark, path).collect()} == {"s1": 1.0, "s2": 5.0}
        assert S.append_new_signatures(df, path) == 0
        assert S.stored_table(spark, path).columns == ["pert_iname", "sig_id", "pr_gene_symbol", "z_score", "is_significant"]


@pytest.mark.parametrize("kind", ["tsv", "arrays"])
def test_matrix_round_trip_with_gaps(spark, scratch, kind):
    cells = [(f"r{i}", f"c{j:03d}", float(i * 100 + j)) for i in range(6) for j in range(40) if (i * j) % 3 != 1 and j != 39 - i]
    cells += [("r9", "c000", 1.0), ("r8", "c039", 2.0)]
    df = spark.createDataFrame(cells, "sig_id string, gene_id string, z_score double")
    if kind == "tsv":
        back = A.read_matrix_tsv(spark, S.write_matrix_tsv(df, f"{scratch}/m"), row_id="sig_id", col_id="gene_id")
    else:
        back = A.read_matrix_arrays(spark, S.write_matrix_arrays(df, f"{scratch}/m"))
    assert back.count() == 8 * 40
    assert sorted(tuple(r) for r in back.where("z_score is not null").select("sig_id", "gene_id", "z_score").collect()) == sorted(cells)


def test_matrix_writer_grows_with_the_width(spark, scratch):
    def seconds(width):
        df = spark.range(20).crossJoin(spark.range(width).withColumnRenamed("id", "c")).select(
            F.col("id").cast("string").alias("sig_id"), F.format_string("c%06d", "c").alias("gene_id"), F.rand(1).alias("z_score"))
        t = time.perf_counter()
        S.write_matrix_arrays(df, f"{scratch}/w{width}")
        return time.perf_counter() - t

    seconds(500)
    assert seconds(4000) < 4 * max(1.0, seconds(1000)) + 2


# ---------------------------------------------------------------- jobs, caches, scratch
def test_profiles_need_features(spark):
    empty = spark.createDataFrame([], "pert_iname string, biomarker_count long, avg_response double, max_response double, response_variability double")
    with pytest.raises(ValidationError, match="empty"):
        H.classify_clinical_profiles(empty)


def test_missing_inputs_fail_the_first_phase_and_skip_the_rest(spark, sf_dir, scratch):
    out = phases.full_run(spark, {}, [f"{scratch}/none.parquet"], None, None, scratch, "x", ["g"]).collect()
    assert [(r.phase, r.status) for r in out] == [("phase1_extract", "failed: ValidationError"), ("phase2_store", "skipped"), ("phase3_questions", "skipped"),
                                                  ("phase4_literature", "skipped"), ("phase5_profiles", "skipped")]


def test_a_root_of_ones_own_is_not_remembered(spark, sf_dir, scratch):
    mine = store.signature_tables(spark, sf_dir)
    build = store.build_of(spark, sf_dir)
    other = store.signature_tables(spark, sf_dir, root=f"{scratch}/own")
    assert store.signature_tables(spark, sf_dir) is mine and other is not mine and store.build_of(spark, sf_dir) == build


def test_shared_scratch_is_required_on_a_cluster():
    class Context:
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValidationError, match="spark.checkpoint.dir"):
        scratch_root(Session())


def test_best_partners_skip_blocks_that_cannot_reach(spark):
    import random

    from sigspark.operators import partners as P

    rng = random.Random(6)
    genes = [f"g{i}" for i in range(60)]
    sets = {f"K{i:03}": rng.sample(genes, 40 if i < 20 else rng.randint(1, 8)) for i in range(200)}
    sets |= {f"BRD-{i}": rng.sample(genes, 30) for i in range(40)} | {"BRD-alone": ["only"], "BRD-one": ["g0"]}
    pairs = spark.createDataFrame([(c, g, not c.startswith("BRD")) for c, gs in sets.items() for g in gs], "pert_iname string, pr_gene_symbol string, known boolean")
    want = {}
    for u in (c for c in sets if c.startswith("BRD")):
        n, name = max(((len(set(sets[u]) & set(sets[k])), k) for k in sets if k.startswith("K")), key=lambda x: (x[0], [-ord(c) for c in x[1]]))
        if n:
            want[u] = (name, n)
    for block in (10, 1000):
        assert {r.pert_iname: (r.best_match, r.shared_genes) for r in P.best_partners(pairs, block).collect()} == want
    sizes = sorted(((len(g), 1) for c, g in sets.items() if c.startswith("K")), reverse=True)
    merged = {}
    for n, c in sizes:
        merged[n] = merged.get(n, 0) + c
    rest = spark.createDataFrame([(u, len(set(sets[u])), n) for u, (_, n) in want.items()], "pert_iname string, n int, best int")
    went = P.visits(rest, sorted(merged.items(), reverse=True), 10).groupBy("pert_iname").count().collect()
    assert sum(r["count"] for r in went) < 0.2 * len(want) * 19  # of 19 blocks after the first
