"""Gold marts: three group-by tables over silver.

Each mart is one hash aggregate with a map-side partial aggregate, so the few
group keys (tens of districts, a handful of room counts) cannot skew a reducer.
No sort is applied here: a sort is not a stored order for Parquet or JDBC
targets, so readers sort (see ``order_*`` and ``plans.sqlapi``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from estatelake.functions.exact import avg_of_sums, exact_avg, exact_parts, merged_sums, sums_of_parts

# The columns that the marts average.
MEASURES = ("price", "price_per_sqm", "area")
GROUPS = ("district", "listing_date", "rooms", "_rooms_ok")


def mart_by_district(silver: DataFrame) -> DataFrame:
    """district → avg_price, avg_price_per_sqm, listing_count.  NULL district is a group."""
    return silver.groupBy("district").agg(
        exact_avg("price").alias("avg_price"),
        exact_avg("price_per_sqm").alias("avg_price_per_sqm"),
        F.count(F.lit(1)).alias("listing_count"),
    )


def mart_by_day(silver: DataFrame) -> DataFrame:
    """listing_date → listings_count, avg_price, avg_price_per_sqm.  NULL date is a group."""
    return (
        silver.select(
            F.to_date("published_at").alias("listing_date"), "price", "price_per_sqm"
        )
        .groupBy("listing_date")
        .agg(
            F.count(F.lit(1)).alias("listings_count"),
            exact_avg("price").alias("avg_price"),
            exact_avg("price_per_sqm").alias("avg_price_per_sqm"),
        )
    )


def mart_by_rooms(silver: DataFrame) -> DataFrame:
    """rooms (> 0) → avg_price, avg_price_per_sqm, avg_area_sqm, listing_count."""
    return (
        silver.where(F.col("rooms").isNotNull() & (F.col("rooms") > 0))
        .groupBy("rooms")
        .agg(
            exact_avg("price").alias("avg_price"),
            exact_avg("price_per_sqm").alias("avg_price_per_sqm"),
            exact_avg("area").alias("avg_area_sqm"),
            F.count(F.lit(1)).alias("listing_count"),
        )
    )


def build_marts(silver: DataFrame) -> dict[str, DataFrame]:
    """All three marts under their table names."""
    return {
        "mart_avg_price_by_district": mart_by_district(silver),
        "mart_listings_by_day": mart_by_day(silver),
        "mart_avg_price_by_rooms": mart_by_rooms(silver),
    }


def order_by_district(mart: DataFrame) -> DataFrame:
    """Display order of mart 1: dearest first, NULL prices last, ties by district."""
    return mart.orderBy(F.col("avg_price").desc_nulls_last(), F.col("district").asc_nulls_last())


def order_by_day(mart: DataFrame) -> DataFrame:
    """Display order of mart 2: by date, the NULL date last."""
    return mart.orderBy(F.col("listing_date").asc_nulls_last())


def order_by_rooms(mart: DataFrame) -> DataFrame:
    """Display order of mart 3: by room count."""
    return mart.orderBy(F.col("rooms").asc_nulls_last())


def _grouped(silver: DataFrame) -> GroupedData:
    """Silver grouped for all three marts at once (GROUPING SETS).

    The measures are made decimals here, once per row of silver: above, each row stands once per grouping set.
    """
    rows = silver.select(
        "district",
        F.to_date("published_at").alias("listing_date"),
        "rooms",
        *[part.alias(f"_{m}_{k}") for m in MEASURES for k, part in exact_parts(m).items()],
        (F.col("rooms").isNotNull() & (F.col("rooms") > 0)).alias("_rooms_ok"),
    )
    return rows.groupingSets([["district"], ["listing_date"], ["rooms", "_rooms_ok"]], *GROUPS)


def _sums(measure: str) -> dict[str, Column]:
    """``exact_sums`` of a measure over the rows of ``_grouped``."""
    return sums_of_parts({k: F.col(f"_{measure}_{k}") for k in ("sum", "rest", "n")})


def marts_aggregate(silver: DataFrame) -> DataFrame:
    """All three marts' groups from one scan of silver and one shuffle (GROUPING SETS).

    Each silver row is expanded once per grouping set before the map-side
    partial aggregate, so the shuffle carries one row per (set, key, task).
    The result holds one row per district, day and room count (``_gid`` tells
    the set apart), so its size is bounded by the number of groups.
    """
    return _grouped(silver).agg(
        F.grouping_id().alias("_gid"),
        *[avg_of_sums(_sums(m)).alias(f"avg_{m}") for m in MEASURES],
        F.count(F.lit(1)).alias("n"),
    ).withColumnRenamed("avg_area", "avg_area_sqm")


def marts_partial(silver: DataFrame) -> DataFrame:
    """The sums and counts of ``marts_aggregate`` for some rows of silver: one row per group of these rows.

    Partials of disjoint sets of rows are merged by ``merge_partials``, so a run needs to read its new rows only.
    """
    parts = [col.alias(f"{m}_{k}") for m in MEASURES for k, col in _sums(m).items()]
    return _grouped(silver).agg(F.grouping_id().alias("_gid"), *parts, F.count(F.lit(1)).alias("n"))


def _merged(partials: DataFrame) -> tuple[GroupedData, dict[str, dict[str, Column]]]:
    return partials.groupBy("_gid", *GROUPS), {m: merged_sums(m) for m in MEASURES}


def add_partials(partials: DataFrame) -> DataFrame:
    """Partials of any number of runs as one partial per group."""
    groups, sums = _merged(partials)
    return groups.agg(*[c.alias(f"{m}_{k}") for m in MEASURES for k, c in sums[m].items()], F.sum("n").alias("n"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """What ``marts_aggregate`` gives over all rows that the partials stand for."""
    groups, sums = _merged(partials)
    averages = [avg_of_sums(sums[m]).alias(f"avg_{m}") for m in MEASURES]
    return groups.agg(*averages, F.sum("n").alias("n")).withColumnRenamed("avg_area", "avg_area_sqm")


def split_marts(agg: DataFrame) -> dict[str, DataFrame]:
    """The three mart tables out of ``marts_aggregate``."""
    # grouping_id bits follow the column order: district, listing_date, rooms, _rooms_ok
    by_district = agg.where(F.col("_gid") == 0b0111).select(
        "district", "avg_price", "avg_price_per_sqm", F.col("n").alias("listing_count")
    )
    by_day = agg.where(F.col("_gid") == 0b1011).select(
        "listing_date", F.col("n").alias("listings_count"), "avg_price", "avg_price_per_sqm"
    )
    by_rooms = agg.where((F.col("_gid") == 0b1100) & F.col("_rooms_ok")).select(
        "rooms", "avg_price", "avg_price_per_sqm", "avg_area_sqm",
        F.col("n").alias("listing_count"),
    )
    return {
        "mart_avg_price_by_district": by_district,
        "mart_listings_by_day": by_day,
        "mart_avg_price_by_rooms": by_rooms,
    }


def build_marts_one_pass(silver: DataFrame) -> dict[str, DataFrame]:
    """Same tables as ``build_marts``, from a single aggregate."""
    return split_marts(marts_aggregate(silver))
