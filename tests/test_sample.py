"""Exact and Bernoulli samples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from estatelake.operators.sample import bernoulli_sample, exact_sample, sample_size


@pytest.mark.parametrize("n,frac", [(1000, 0.1), (999, 0.1), (17, 0.5), (5, 0.0), (5, 1.0), (20000, 0.37)])
def test_exact_size(spark, n, frac):
    df = spark.range(n).withColumn("v", F.col("id") * 2)
    got = exact_sample(df, frac, key=["id"], seed=7)
    rows = got.collect()
    assert len(rows) == sample_size(n, frac)
    assert len({r["id"] for r in rows}) == len(rows)
    assert got.columns == df.columns


def test_exact_is_deterministic_and_seeded(spark):
    df = spark.range(5000)
    a = sorted(r.id for r in exact_sample(df, 0.1, ["id"], seed=1).collect())
    b = sorted(r.id for r in exact_sample(df.repartition(7), 0.1, ["id"], seed=1).collect())
    c = sorted(r.id for r in exact_sample(df, 0.1, ["id"], seed=2).collect())
    assert a == b and a != c


def test_bernoulli_is_near(spark):
    n = spark.range(20000).transform(lambda d: bernoulli_sample(d, 0.1, seed=3)).count()
    assert 1700 < n < 2300


def test_exact_size_over_repeated_rows(spark):
    """A third of the rows are equal: the size is exact, copies are drawn one by one, and none is held in one task."""
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("v")).repartition(6)
    got = exact_sample(rows, 0.1, key=None, seed=5)
    values = [r["v"] for r in got.collect()]
    assert len(values) == 300 and got.columns == ["v"]
    assert 60 < values.count(-1) < 140  # about a third of them, neither all copies nor none
    assert len(set(values) - {-1}) == 300 - values.count(-1)
    other = [r["v"] for r in exact_sample(rows, 0.1, key=None, seed=6).collect()]
    assert sorted(other) != sorted(values) and len(other) == 300


def test_a_key_that_repeats_still_gives_the_size(spark):
    """Rows with one key share one hash: the tied ones are taken by counts per task, without a window over them."""
    from tests.helpers import plan_text

    rows = spark.range(900).select(F.lit(1).alias("k"), "id").repartition(5)
    got = exact_sample(rows, 0.1, key=["k"], seed=1)
    assert len({r["id"] for r in got.collect()}) == 90
    assert "Window" not in plan_text(got, "simple")
