"""Every operator query that SQL can express, against its statement."""

import pytest

from sigspark.llm.queries import ORACLE, QUERIES
from tools.parity import compare


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, duck, key):
    assert "error" not in compare(QUERIES[key](spark, sf_dir), duck, ORACLE[key])


def test_one_query_per_operator():
    assert sorted(k.split("_")[0] for k in QUERIES) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])
