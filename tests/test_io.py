"""Partitioned Parquet, CSV and JDBC round trips."""

from __future__ import annotations

import datetime as dt

import pytest

from estatelake.operators import marts as M
from estatelake.sinks.jdbc import write_marts
from estatelake.sinks.parquet import append_partitioned
from estatelake.sources.files import read_csv, read_jdbc, read_silver
from estatelake.operators.refine import refine
from estatelake.sources.listings import as_bronze
from tests.helpers import plan_text

REC = (
    "price double, area double, rooms int, floor int, total_floors int, district string, "
    "address string, building_type string, published_at string"
)


def silver_of(spark, districts):
    rows = [(1.0 + i, 1.0, 1, 1, 1, d, f"a{i}", "b", "2024-01-01 00:00:00") for i, d in enumerate(districts)]
    return refine(as_bronze(spark.createDataFrame(rows, REC)))


def test_partition_text_survives(spark, scratch):
    path = scratch("partition_text")
    districts = ["1", "02", "", None, "a b/c#d"]
    append_partitioned(silver_of(spark, districts), path)
    back = read_silver(spark, path)
    assert back.schema["district"].dataType.simpleString() == "string"
    assert sorted(r["district"] or "<null>" for r in back.collect()) == sorted(
        ["1", "02", "<null>", "<null>", "a b/c#d"]
    )


def test_partition_pruning(spark, scratch):
    path = scratch("prune")
    append_partitioned(silver_of(spark, ["A", "B", "C"]), path)
    df = read_silver(spark, path).where("district = 'B'")
    plan = plan_text(df, "formatted")
    assert "PartitionFilters: [isnotnull(district" in plan and "(district#" in plan
    assert df.count() == 1


def test_csv_with_schema(spark, scratch):
    path = scratch("csv")
    df = spark.createDataFrame([(1, "x, y", 2.5), (2, None, None)], "id long, name string, v double")
    df.write.option("header", "true").csv(path)
    back = read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_csv_by_name_with_quotes_and_line_breaks(spark, scratch):
    path = scratch("csv_by_name")
    text = 'area,note,price,address\r\n1.5,x,20.0,"say ""hi"", 5"\r\n2.5,y,30.0,"two\nlines"\r\n'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    back = read_csv(spark, path, "price double, area double, address string", multiline=True)
    assert back.columns == ["price", "area", "address"]
    assert sorted(map(tuple, back.collect())) == [(20.0, 1.5, 'say "hi", 5'), (30.0, 2.5, "two\nlines")]
    with pytest.raises(ValueError, match="floor"):
        read_csv(spark, path, "price double, floor int")


def test_csv_files_with_another_header_fail(spark, scratch):
    path = scratch("csv_headers")
    df = spark.createDataFrame([(1.0, 2.0)], "price double, area double")
    df.write.option("header", "true").csv(path)
    df.select("area", "price").write.mode("append").option("header", "true").csv(path)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, df.schema).collect()


def test_jdbc_overwrite_keeps_one_copy(spark):
    """Embedded in-memory Derby (in this JVM only: no server, no port)."""
    url = "jdbc:derby:memory:estatelake_marts;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    s = silver_of(spark, ["A", "B", None])
    marts = M.build_marts(s)
    write_marts(marts, url, props)
    write_marts(marts, url, props)  # second run replaces, does not append
    back = read_jdbc(spark, url, "mart_avg_price_by_district", props)
    assert back.count() == 3
    day = read_jdbc(spark, url, "mart_listings_by_day", props).collect()
    assert day[0]["listing_date"] == dt.date(2024, 1, 1) and day[0]["listings_count"] == 3
    split = read_jdbc(spark, url, "mart_avg_price_by_district", props,
                      column="listing_count", lower_bound=0, upper_bound=9, num_partitions=3)
    assert split.rdd.getNumPartitions() == 3 and split.count() == 3
