"""Every registered query against its DuckDB oracle.

Runs on ``SIGSPARK_TEST_SF`` (default sf0.001); the driver repeats the
same comparison at sf0.01.
"""

import pytest

import __spark_entry__ as entry
from sigspark.plans.registry import QUERIES as BASE
from tools.parity import compare

QUERIES = dict(BASE)
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLE))


def test_every_query_has_an_oracle_or_is_documented_rows_only():
    assert ROWS_ONLY == ["profile_forest", "profile_forest_metrics"]
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, duck, key):
    info = compare(QUERIES[key](spark, sf_dir), duck, ORACLE[key])
    assert "error" not in info, info


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_queries_run(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["pert_iname", "moa", "canonical_smiles", "pubchem_cid", "max_potency", "total_gene_hits"]
    assert 0 < len(rows) <= 10
    potencies = [r["max_potency"] for r in rows]
    assert potencies == sorted(potencies, reverse=True)
