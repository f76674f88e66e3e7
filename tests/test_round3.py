"""Findings of round 3: bounded index slices, landing, confusion counts, appends."""

import itertools

from pyspark.sql import functions as F


def test_postings_sort_a_bounded_number_of_words_at_a_time(spark):
    import pyarrow as pa

    from sigspark.plans import literature as Lit

    words = [["a", "b", "a"], [], ["c"] * 7, ["b", "a"], ["d"], []]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(words, pa.list_(pa.string()))], names=["doc_id", "words"])
    out = [b.to_pylist() for b in Lit._grouper(4)(iter([batch, batch.slice(2, 3)]))]
    assert all(sum(len(r["positions"]) for r in rows) <= 4 or len({r["doc_id"] for r in rows}) == 1 for rows in out)

    def expected(docs):
        return sorted((w, d, [i for i, x in enumerate(words[d]) if x == w]) for d in docs for w in set(words[d]))
    got = sorted((r["token"], r["doc_id"], r["positions"]) for r in itertools.chain(*out))
    assert got == sorted(expected(range(6)) + expected(range(2, 5)))
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "doc_id int, text string").coalesce(1)
    assert sorted((r.token, r.doc_id, r.positions) for r in Lit.postings(docs).collect()) == expected(range(6))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_metadata_of_names_repeated_on_both_sides_needs_no_pairs(spark):
    from sigspark.plans.jobs import build_signatures, expression_names, expression_table

    inputs = {
        "gene_info": spark.createDataFrame([("g1", "A", 1), ("g1", "A", 1), ("g2", "B", 0)], "pr_gene_id string, pr_gene_symbol string, pr_is_lm int"),
        "sig_info": spark.createDataFrame([(s, n, t, "MCF7", 10.0, "µM", "6 h") for s, n, t in
                                           (("s1", "x", "trt_cp"), ("s1", "x", "trt_cp"), ("s2", "y", "trt_cp"), ("s3", "z", "trt_sh"),
                                            ("s4", None, "trt_cp"), (None, "w", "trt_cp"), ("s5", "v", "trt_cp"))],
                                          "sig_id string, pert_iname string, pert_type string, cell_id string, pert_dose double, pert_dose_unit string, pert_itime string"),
        "matrix_long": spark.createDataFrame([("g1", "s1", 3.0), ("g1", "s1", 1.0), ("g2", "s2", 5.0), ("g1", "s3", 5.0), ("g1", "s4", 4.0),
                                              ("g1", None, 4.0), ("g1", "s5", float("nan")), ("g1", "s2", 0.5)], "gene_id string, sig_id string, z_score double"),
        "pert_info": spark.createDataFrame([("x", "C2", "c1"), ("x", None, "c9"), ("x", None, "c3"), ("y", "C", None), ("v", "C", "c"), (None, "C", "c")],
                                           "pert_iname string, canonical_smiles string, pubchem_cid string"),
        "repurposing": spark.createDataFrame([("x", "m2", "t1"), ("x", "m1", "t2"), ("x", "m1", "t1"), ("v", None, None)],
                                             "pert_iname string, moa string, target string"),
    }
    three = [inputs[k] for k in ("gene_info", "sig_info", "matrix_long")]
    names = expression_names(*three)
    assert sorted(map(str, (r[0] for r in names.collect()))) == ["None", "x", "y"]
    assert set(names.collect()) == set(expression_table(*three).select("pert_iname").distinct().collect())
    metadata = build_signatures(inputs).compound_metadata
    assert sorted(map(tuple, metadata.collect())) == [("x", "m1", "t1", None, "c3"), ("y", None, None, "C", None)]
    assert _plan(metadata).count("row_number()") >= 3  # each side is one row a name before they are combined


def test_signature_info_joins_one_row_per_signature(spark, sf_dir):
    from sigspark.sources import binding as Bd

    part = spark.createDataFrame([(p, f"b{p}", "T", 20) for p in (1, 1, 2, 3)], "p_partkey long, p_brand string, p_type string, p_size int")
    supplier = spark.createDataFrame([(1, 2, "S1"), (1, 2, "S1"), (2, 3, None), (9, 4, "S9")], "s_suppkey long, s_nationkey int, s_name string")
    lineitem = spark.createDataFrame(
        [(o, p, s, st, 5.0) for o in (1, 2, 6, -4, None) for p in (1, 2, 7, None) for s in (1, 2, 5, 9, None) for st in ("F", "O", None)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linestatus string, l_quantity double")
    keys = spark.sql(Bd.COMPOUND_KEY_SQL, supplier=supplier)

    def rows(lines):
        assay = spark.sql(Bd.ASSAY_SQL, lineitem=lines, part=part, compound_key=keys)
        return sorted(map(str, spark.sql(Bd.SIG_INFO_SQL, assay=assay).collect()))
    few = Bd._readouts(lineitem, part)
    assert rows(few) == rows(lineitem)
    assert few.count() < lineitem.count() / 4
    assert "min(l_partkey" in _plan(Bd.bind_inputs(spark, sf_dir)["sig_info"])


def test_classification_metrics_make_their_rows_once(spark):
    from sigspark.plans.profiles import classification_metrics

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        made.add(1)
        return x

    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a"), (None, "a"), ("a", None), (None, None)]
    df = spark.createDataFrame(pairs, "t string, p string").repartition(2)
    row = classification_metrics(df.select("t", counted("p").alias("p")), "t", "p").collect()[0]
    assert made.value == len(pairs)
    n, hit = len(pairs), 3
    # weighted over the true labels a (3), b (2), c (1), and the two null labels, which match nothing
    prec, rec = {"a": 1 / 3, "b": 2 / 3, "c": 0}, {"a": 1 / 3, "b": 1, "c": 0}
    support = {"a": 3, "b": 2, "c": 1}
    assert row.accuracy == round(hit / n, 6)
    assert row.precision_weighted == round(sum(support[k] * prec[k] for k in support) / n, 6)
    assert row.recall_weighted == round(sum(support[k] * rec[k] for k in support) / n, 6)
    empty = classification_metrics(df.where("t = 'zz'"), "t", "p").collect()[0]
    assert list(empty) == [None] * 4


def test_an_append_looks_for_stored_keys_without_ordering_the_batch(spark, scratch, monkeypatch):
    from sigspark.sources import keyed as K

    seen, real = [], K.stored_keys
    monkeypatch.setattr(K, "stored_keys", lambda batch, *a: (seen.append(_plan(batch)), real(batch, *a))[1])
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    assert K.append_rows(first, f"{scratch}/t", ["k"]) == 3
    assert K.append_rows(first.unionByName(spark.createDataFrame([("c", 7), ("c", 5)], "k string, v int")), f"{scratch}/t", ["k"]) == 1
    assert sorted(map(str, (tuple(r) for r in K.stored_table(spark, f"{scratch}/t").collect()))) == ["('a', 1)", "('b', 3)", "('c', 5)", "(None, 4)"]
    assert len(seen) == 2 and not any("row_number" in p for p in seen)
