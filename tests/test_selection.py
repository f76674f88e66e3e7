"""Values by rank without a sort: ties, tails, infinities, several steps."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.operators import stats
from sigspark.operators.stats import exact_quantiles

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]

COLUMNS = {
    "continuous": lambda: F.rand(3) * 100 - 50,
    "third_equal": lambda: F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.randn(5) * 3 + 7),
    "few_values": lambda: (F.col("id") % 4).cast("double"),
    "one_value": lambda: F.lit(-2.5),
    "many_magnitudes": lambda: F.exp(F.randn(7) * 150),
    "one_far_value": lambda: F.when(F.col("id") == 17, 1e300).otherwise(F.rand(9)),
    "neighbours": lambda: F.lit(1.0) + (F.col("id") % 5) * F.lit(math.ulp(1.0)),
    "both_zeros": lambda: F.when(F.col("id") % 2 == 0, -0.0).otherwise(0.0),
}


@pytest.mark.parametrize("kind", sorted(COLUMNS))
def test_equals_numpy(spark, scratch, monkeypatch, kind):
    monkeypatch.setattr(stats, "CANDIDATES", 500)  # every kind needs steps
    df = spark.range(40_000, numPartitions=6).select(COLUMNS[kind]().cast("double").alias("x"))
    df.write.parquet(f"{scratch}/t")
    df = spark.read.parquet(f"{scratch}/t")
    want = np.quantile(df.toPandas()["x"].to_numpy(), PROBS)
    assert list(exact_quantiles(df, "x", PROBS).first()) == pytest.approx(list(want), rel=1e-14, abs=0)


def test_a_coarse_sketch_takes_more_steps_and_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(stats, "CANDIDATES", 10)
    monkeypatch.setattr(stats, "SKETCH_ACCURACY", 5)
    steps = []
    narrowed = stats._narrowed
    monkeypatch.setattr(stats, "_narrowed", lambda *a: steps.append(1) or narrowed(*a))
    df = spark.range(20_000, numPartitions=4).select((F.col("id") * 7919 % 20011).cast("double").alias("x"))
    want = np.quantile(np.array([i * 7919 % 20011 for i in range(20_000)], float), [0.25, 0.5])
    assert list(exact_quantiles(df, "x", [0.25, 0.5]).first()) == list(want)
    assert 2 <= len(steps) <= 40


def test_few_rows_empty_nulls_and_infinities(spark):
    rows = [(float("inf"),), (float("-inf"),), (None,), (float("nan"),), (1.0,), (2.0,), (2.0,)]
    df = spark.createDataFrame(rows, "x double")
    assert list(exact_quantiles(df, "x", [0.25, 0.5, 0.75], names=["a", "b", "c"]).first()) == [1.0, 2.0, 2.0]
    assert list(exact_quantiles(df.where("x = 1"), "x", [0.0, 0.5]).first()) == [1.0, 1.0]
    assert list(exact_quantiles(df.limit(0), "x", [0.5]).first()) == [None]


def test_infinities_with_steps(spark, monkeypatch):
    monkeypatch.setattr(stats, "CANDIDATES", 50)
    x = F.when(F.col("id") % 10 == 0, float("inf")).when(F.col("id") % 10 == 1, float("-inf")).otherwise(F.col("id").cast("double"))
    df = spark.range(5000).select(x.alias("x"))
    values = sorted(float("inf") if i % 10 == 0 else float("-inf") if i % 10 == 1 else float(i) for i in range(5000))
    got = exact_quantiles(df, "x", [0.05, 0.5, 0.95]).first()
    mid = (values[2499] + values[2500]) / 2
    assert list(got) == [float("-inf"), mid, float("inf")]
