"""Gold marts: contract, NULL groups, exact averages, one-pass equivalence."""

from __future__ import annotations

import datetime as dt

from estatelake.operators import marts as M
from estatelake.operators.refine import refine
from estatelake.schemas import MART_BY_DAY, MART_BY_DISTRICT, MART_BY_ROOMS
from estatelake.sources.listings import as_bronze
from tests.conftest import SF_SMALL
from tests.helpers import plan_text

REC = (
    "price double, area double, rooms int, floor int, total_floors int, district string, "
    "address string, building_type string, published_at string"
)

ROWS = [
    (100.0, 10.0, 1, 1, 5, "A", "a1", "b", "2024-01-01 10:00:00"),
    (200.0, 10.0, 2, 1, 5, "A", "a2", "b", "2024-01-01 11:00:00"),
    (300.0, 0.0, 2, 1, 5, None, "a3", "b", "2024-01-02 11:00:00"),
    (0.1, 1.0, 0, 1, 5, "B", "a4", "b", "bad"),
    (0.2, 1.0, None, 1, 5, "B", "a5", "b", "2024-01-02 12:00:00"),
]


def silver(spark):
    return refine(as_bronze(spark.createDataFrame(ROWS, REC)))


def names_types(df):
    return [(f.name, f.dataType) for f in df.schema.fields]


def test_contract(spark):
    s = silver(spark)
    assert names_types(M.mart_by_district(s)) == [(f.name, f.dataType) for f in MART_BY_DISTRICT.fields]
    assert names_types(M.mart_by_day(s)) == [(f.name, f.dataType) for f in MART_BY_DAY.fields]
    assert names_types(M.mart_by_rooms(s)) == [(f.name, f.dataType) for f in MART_BY_ROOMS.fields]


def test_null_groups_and_exact_average(spark):
    s = silver(spark)
    by_d = {r["district"]: r for r in M.mart_by_district(s).collect()}
    assert set(by_d) == {"A", "B", None}
    assert by_d["A"]["avg_price"] == 150.0 and by_d["A"]["listing_count"] == 2
    assert by_d["B"]["avg_price"] == 0.15  # 0.1 + 0.2 summed exactly
    assert by_d[None]["avg_price_per_sqm"] is None  # only a zero-area listing
    by_day = {r["listing_date"]: r["listings_count"] for r in M.mart_by_day(s).collect()}
    assert by_day == {dt.date(2024, 1, 1): 2, dt.date(2024, 1, 2): 2, None: 1}
    rooms = {r["rooms"]: r["listing_count"] for r in M.mart_by_rooms(s).collect()}
    assert rooms == {1: 1, 2: 2}  # NULL and 0 rooms left out


def test_counts_sum_to_silver(spark):
    from estatelake.plans.catalog import silver as silver_of

    s = silver_of(spark, SF_SMALL)
    n = s.count()
    assert sum(r["listing_count"] for r in M.mart_by_district(s).collect()) == n
    assert sum(r["listings_count"] for r in M.mart_by_day(s).collect()) == n


def test_one_pass_equals_separate(spark):
    from estatelake.plans.catalog import silver as silver_of

    s = silver_of(spark, SF_SMALL)
    sep = M.build_marts(s)
    one = M.build_marts_one_pass(s)
    for name in sep:
        a = sorted(map(tuple, sep[name].collect()), key=str)
        b = sorted(map(tuple, one[name].collect()), key=str)
        assert a == b, name
        assert sep[name].columns == one[name].columns


def test_one_pass_reads_silver_once(spark):
    s = silver(spark)
    agg = M.marts_aggregate(s)
    plan = plan_text(agg, "simple")
    assert plan.count("Expand") == 1


def test_marts_keep_partial_aggregation(spark):
    s = silver(spark)
    plan = plan_text(M.mart_by_district(s), "simple")
    assert "partial_sum" in plan and "HashAggregate" in plan


def test_display_order_nulls_last(spark):
    s = silver(spark)
    days = [r["listing_date"] for r in M.order_by_day(M.mart_by_day(s)).collect()]
    assert days[-1] is None
    prices = [r["avg_price"] for r in M.order_by_district(M.mart_by_district(s)).collect()]
    assert prices == sorted(prices, reverse=True)
