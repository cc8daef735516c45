"""Work per task and per row: silver reads bronze in small splits, marts make decimals once per row."""

from __future__ import annotations

import random

import pytest

from estatelake import session
from estatelake.operators.marts import MEASURES, build_marts, marts_aggregate, split_marts
from estatelake.schemas import BRONZE, SILVER
from estatelake.session import fine_splits
from estatelake.sources.files import read_silver
from estatelake.streaming import incremental
from tests.helpers import plan_text

NAMES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum")


def settings(spark):
    return [spark.conf.get(name, None) for name in NAMES]


def bronze(spark, path):
    rnd = random.Random(3)
    rows = [(1.0 + rnd.random(), 10.0, 1, 1, 5, f"d{i % 3}", f"{rnd.getrandbits(128):x}", "b", "2024-01-02 03:04:05", "now", None, None)
            for i in range(6000)]
    spark.createDataFrame([*rows, *rows[:500]], BRONZE).coalesce(1).write.parquet(path)


def test_silver_reads_bronze_in_small_splits(spark, scratch, monkeypatch):
    root = scratch("splits")
    bronze(spark, f"{root}/bronze")
    before, parts, append = settings(spark), [], incremental.append_new

    def seen(batch, *args, **kwargs):
        parts.append(batch.rdd.getNumPartitions())
        append(batch, *args, **kwargs)

    monkeypatch.setattr(incremental, "append_new", seen)
    monkeypatch.setattr(session, "SPLIT_BYTES", 32 * 1024, raising=False)
    report = {}
    incremental.run_incremental_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck", report=report)
    assert len(parts) == 1 and parts[0] > 4
    assert report["bronze_rows"] == 6500 and report["silver_appended"] == 6000
    assert read_silver(spark, f"{root}/silver").count() == 6000
    assert settings(spark) == before


def test_settings_are_put_back_and_smaller_splits_kept(spark):
    before = settings(spark)
    with pytest.raises(RuntimeError), fine_splits(spark):
        assert int(spark.conf.get(NAMES[0])) == session.SPLIT_BYTES
        assert int(spark.conf.get(NAMES[1])) >= session.SPLITS_PER_CORE * spark.sparkContext.defaultParallelism
        raise RuntimeError
    assert settings(spark) == before
    try:
        spark.conf.set(NAMES[0], "1m")
        spark.conf.set(NAMES[1], "5000")
        with fine_splits(spark):
            assert [int(v) for v in settings(spark)] == [1024 * 1024, 5000]
        assert settings(spark) == ["1m", "5000"]
    finally:
        for name in NAMES:
            spark.conf.unset(name)


def test_decimals_are_made_below_the_expand(spark):
    odd = [None, float("nan"), float("inf"), 1e23, -0.0, 0.0000005, 12.34, 9e21]
    rows = [(p, a, r, 1, 5, "a", "b", None, "now", None, None, p, None, d)
            for p in odd for a in odd[:5] for r in (None, 0, 2) for d in (None, "x")]
    silver = spark.createDataFrame(rows, SILVER)
    agg = marts_aggregate(silver)
    plan = agg._jdf.queryExecution().optimizedPlan().toString().split("\n")
    expand = next(i for i, line in enumerate(plan) if "Expand" in line)
    assert not any("as decimal(28,6)" in line for line in plan[:expand])
    assert any(line.count("as decimal(28,6)") >= len(MEASURES) for line in plan[expand:])
    assert "HashAggregate" in plan_text(agg) and "SortAggregate" not in plan_text(agg)
    for name, mart in split_marts(agg).items():
        wanted = build_marts(silver)[name].select(*mart.columns).collect()
        assert sorted(map(str, mart.collect())) == sorted(map(str, wanted))
