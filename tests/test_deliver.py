"""The listings that each of two runs delivers, on rows of its own."""

from __future__ import annotations

import datetime as dt

from estatelake.plans.catalog import listings_of_run, run_no
from estatelake.sources.listings import listings

LINE = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_shipdate timestamp")
PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int"


def tables(spark, scratch):
    at = scratch("deliver")
    day = dt.datetime(2020, 1, 2)
    lines = [(k, k % 3, 1, n, 10.0 + k, 100.0 * k, day) for k in [*range(1, 41), 10, 10, 7] for n in (1, 2)]
    lines += [(None, 1, 1, 1, 1.0, 1.0, day), (10, 1, 1, None, 1.0, 1.0, day), (7, 1, 1, None, 1.0, 1.0, day), (8, 99, 1, 1, 1.0, 1.0, day)]
    spark.createDataFrame(lines, LINE).write.parquet(f"{at}/lineitem.parquet")
    parts = [(k, f"name {k}", "Brand#13", "SMALL", k) for k in (0, 1, 2)]
    spark.createDataFrame(parts, PART).write.parquet(f"{at}/part.parquet")
    return at


def test_each_run_has_the_listings_that_run_no_deals_to_it(spark, scratch):
    at = tables(spark, scratch)
    for run in (1, 2):
        wanted = listings(spark, at).where(run_no() == run).collect()
        got = listings_of_run(spark, at, run).collect()
        assert len(got) > 40
        assert sorted(map(str, got)) == sorted(map(str, wanted))


def test_rows_of_the_other_run_go_before_the_join(spark, scratch):
    plan = listings_of_run(spark, tables(spark, scratch), 1)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    assert any("Filter" in line and "l_linenumber" in line and "% 2" in line for line in plan[join:])
