"""Listings adapter: derives dirty listing records from the driver's TPC-H-like tables.

The reference reads a CSV of listings that is not published.  Its fields are
re-created from ``lineitem ⨝ part`` with fixed dirt rules, so that every stage
has NULLs, zero areas, bad dates and exact copies to deal with, and all the work
grows with the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.functions.timefmt import iso_stamp

# Dirt rules of the fixture (modulus → effect), applied to all rows.
NULL_PRICE_EVERY = 97  # l_orderkey % 97 == 0  → price NULL
NAN_PRICE_EVERY = 61  # l_orderkey % 61 == 0  → price NaN
LARGE_PRICE_EVERY = 53  # l_orderkey % 53 == 0 in LARGE_PRICE_BRAND → price 1e13
LARGE_PRICE_BRAND = "Brand#12"
INFINITE_PRICE_BRAND = "Brand#11"  # l_orderkey % 5 == 0 and l_linenumber == 7 there → price Infinity
NULL_AREA_EVERY = 89  # l_orderkey % 89 == 0  → area NULL
ZERO_AREA_EVERY = 83  # l_orderkey % 83 == 0  → area 0.0
NAN_AREA_EVERY = 73  # l_orderkey % 73 == 0  → area NaN
MINUS_ZERO_AREA_EVERY = 67  # l_orderkey % 67 == 0  → area -0.0
TINY_AREA_EVERY = 71  # l_orderkey % 71 == 0  → area 0.00001
NULL_ROOMS_EVERY = 13  # l_suppkey % 13 == 0   → rooms NULL
NULL_DISTRICT_EVERY = 101  # p_partkey % 101 == 0 → district NULL
BLANK_DISTRICT_EVERY = 103  # p_partkey % 103 == 0 → district '', and NULL in the copy
BAD_DATE_EVERY = 79  # l_orderkey % 79 == 0  → published_at 'n/a', and 'unknown' in the copy
BLANK_DATE_EVERY = 43  # l_orderkey % 43 == 0  → published_at ''
LAST_DATE_EVERY = 41  # l_orderkey % 41 == 0  → published_at 9999-12-31 23:59:59 (odd keys) or 9999-12-30 12:00:00
FIRST_DATE_EVERY = 37  # l_orderkey % 37 == 0  → published_at 0001-01-01 00:00:00
COPY_EVERY = 10  # l_orderkey % 10 == 0  → the listing is sent twice
TOTAL_FLOORS = 25

# Columns a listing record carries besides the message fields.
SOURCE_COLUMNS = ["src_id", "src_line", "copy_no"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing records (message fields without the stamp) + ``src_id, src_line, copy_no``.

    One scan of each table and one join; the exact copies come from an
    ``explode`` over a one- or two-element array, not from a second scan and
    union.  The join has no hint: Catalyst broadcasts ``part`` only while its
    statistics stay under ``autoBroadcastJoinThreshold`` and falls back to a
    sort-merge join (with AQE skew splitting) beyond it.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_shipdate",
    )
    pt = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size"
    )
    ok, sk, pk = F.col("l_orderkey"), F.col("l_suppkey"), F.col("p_partkey")
    joined = li.join(pt, li["l_partkey"] == pt["p_partkey"], "inner")
    odd_price = F.col("p_brand") == INFINITE_PRICE_BRAND
    base = joined.select(
        F.when(ok % NULL_PRICE_EVERY == 0, F.lit(None).cast("double"))
        .when(ok % NAN_PRICE_EVERY == 0, F.lit(float("nan")))
        .when(odd_price & (ok % 5 == 0) & (F.col("l_linenumber") == 7), F.lit(float("inf")))
        .when((F.col("p_brand") == LARGE_PRICE_BRAND) & (ok % LARGE_PRICE_EVERY == 0), F.lit(1e13))
        .otherwise(F.col("l_extendedprice")).alias("price"),
        F.when(ok % NULL_AREA_EVERY == 0, F.lit(None).cast("double"))
        .when(ok % ZERO_AREA_EVERY == 0, F.lit(0.0))
        .when(ok % NAN_AREA_EVERY == 0, F.lit(float("nan")))
        .when(ok % MINUS_ZERO_AREA_EVERY == 0, F.lit(-0.0))
        .when((ok % TINY_AREA_EVERY == 0) & (ok % LARGE_PRICE_EVERY != 0), F.lit(0.00001))
        .otherwise(F.col("l_quantity")).alias("area"),
        F.when(sk % NULL_ROOMS_EVERY == 0, F.lit(None).cast("int"))
        .otherwise(F.col("l_linenumber") - 1).alias("rooms"),
        (F.col("p_size") % 25 + 1).cast("int").alias("floor"),
        F.lit(TOTAL_FLOORS).cast("int").alias("total_floors"),
        F.when(pk % NULL_DISTRICT_EVERY == 0, F.array(F.lit(None).cast("string"), F.lit(None).cast("string")))
        .when(pk % BLANK_DISTRICT_EVERY == 0, F.array(F.lit(""), F.lit(None).cast("string")))
        .otherwise(F.array("p_brand", "p_brand")).alias("district"),
        F.col("p_name").alias("address"),
        F.col("p_type").alias("building_type"),
        F.when(ok % BAD_DATE_EVERY == 0, F.lit("n/a"))
        .when(ok % BLANK_DATE_EVERY == 0, F.lit(""))
        .when(ok % LAST_DATE_EVERY == 0, F.when(ok % 2 == 1, "9999-12-31 23:59:59").otherwise("9999-12-30 12:00:00"))
        .when(ok % FIRST_DATE_EVERY == 0, F.lit("0001-01-01 00:00:00"))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")).alias("published_at"),
        ok.alias("src_id"),
        F.col("l_linenumber").alias("src_line"),
    )
    copies = F.when(
        F.col("src_id") % COPY_EVERY == 0, F.array(F.lit(0), F.lit(1))
    ).otherwise(F.array(F.lit(0)))
    sent = base.withColumn("copy_no", F.explode(copies))
    again = F.col("copy_no") == 1
    return sent.withColumns(
        {
            "district": F.get("district", F.col("copy_no")),
            "published_at": F.when(again & (F.col("published_at") == "n/a"), "unknown").otherwise(F.col("published_at")),
        }
    )


def as_bronze(records: DataFrame) -> DataFrame:
    """Give listing records the bronze lineage columns (batch stand-in for the stream)."""
    now = F.current_timestamp()
    return records.withColumns(
        {
            "current_timestamp": iso_stamp(now),
            "kafka_timestamp": now,
            "bronze_loaded_at": now,
        }
    )


def bronze_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as a bronze table (typed message fields + stamps + source columns)."""
    return as_bronze(listings(spark, sf_dir))
