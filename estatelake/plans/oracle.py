"""Independent DuckDB SQL for every compared query (the correctness oracle).

Only the driver's tables exist as views, so the listings adapter is inlined as a
CTE.  Two cross-engine details are spelled out rather than left to defaults:

* Spark's ``round(double, 2)`` is HALF_UP on the shortest printed digits; the
  oracle rounds the VARCHAR text of the double as a wide DECIMAL.
* averages are sums over counts: an infinity or NaN in a group is its sum, else the sum is exact.

Timestamps and dates are compared as text, because the fixture has the years 1 and 9999.
"""

from __future__ import annotations


def oround(x: str) -> str:
    """Two decimals, HALF_UP on the printed digits; NULL, NaN and the infinities stay."""
    return (
        f"CASE WHEN isfinite({x}) THEN CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE) "
        f"ELSE {x} END"
    )


def oavg(c: str) -> str:
    """Average as sum over count: any value that is not finite decides it, else an exact sum."""
    # Through text both ways: direct casts between doubles and decimals are inexact beyond 2^53 units.
    units = f"CASE WHEN isfinite({c}) THEN CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,6)) END"
    exact = f"CAST(CAST(sum({units}) AS VARCHAR) AS DOUBLE)"
    finite = oround(f"({exact} / CAST(count({c}) AS DOUBLE))")
    return f"CASE WHEN bool_or(NOT isfinite({c})) THEN sum({c}) FILTER (WHERE NOT isfinite({c})) ELSE {finite} END"


DATE_TEXT = "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')"

LISTINGS = f"""
base AS (
  SELECT CASE WHEN l_orderkey % 97 = 0 THEN NULL
              WHEN l_orderkey % 61 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN p_brand = 'Brand#11' AND l_orderkey % 5 = 0 AND l_linenumber = 7 THEN CAST('Infinity' AS DOUBLE)
              WHEN p_brand = 'Brand#12' AND l_orderkey % 53 = 0 THEN CAST(10000000000000 AS DOUBLE)
              ELSE l_extendedprice END AS price,
         CASE WHEN l_orderkey % 89 = 0 THEN NULL
              WHEN l_orderkey % 83 = 0 THEN CAST(0 AS DOUBLE)
              WHEN l_orderkey % 73 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN l_orderkey % 67 = 0 THEN CAST('-0.0' AS DOUBLE)
              WHEN l_orderkey % 71 = 0 AND l_orderkey % 53 <> 0 THEN CAST(0.00001 AS DOUBLE)
              ELSE l_quantity END AS area,
         CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_linenumber - 1 END AS rooms,
         CAST(p_size % 25 + 1 AS INT) AS floor,
         CAST(25 AS INT) AS total_floors,
         CASE WHEN p_partkey % 101 = 0 THEN NULL WHEN p_partkey % 103 = 0 THEN '' ELSE p_brand END AS district,
         p_name AS address,
         p_type AS building_type,
         CASE WHEN l_orderkey % 79 = 0 THEN 'n/a'
              WHEN l_orderkey % 43 = 0 THEN ''
              WHEN l_orderkey % 41 = 0 THEN
                CASE WHEN l_orderkey % 2 = 1 THEN '9999-12-31 23:59:59' ELSE '9999-12-30 12:00:00' END
              WHEN l_orderkey % 37 = 0 THEN '0001-01-01 00:00:00'
              ELSE {DATE_TEXT} END AS published_at,
         l_orderkey AS src_id, l_linenumber AS src_line
  FROM lineitem JOIN part ON l_partkey = p_partkey),
listings AS (
  SELECT *, 0 AS copy_no FROM base
  UNION ALL
  SELECT * REPLACE (NULLIF(district, '') AS district,
                    CASE published_at WHEN 'n/a' THEN 'unknown' ELSE published_at END AS published_at),
         1 AS copy_no
  FROM base WHERE src_id % 10 = 0),
-- as a message carries them: NaN is sent as null
sent AS (
  SELECT * REPLACE (CASE WHEN isnan(price) THEN NULL ELSE price END AS price,
                    CASE WHEN isnan(area) THEN NULL ELSE area END AS area)
  FROM listings)"""

# NaN in results is shown as -1: not every reader of results tells it from NULL.
def shown(c: str) -> str:
    return f"CASE WHEN isnan({c}) THEN -1 ELSE {c} END"


VALID = "price IS NOT NULL AND NOT isnan(price) AND area IS NOT NULL AND NOT isnan(area)"

SILVER = f"""{LISTINGS},
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY district, address, price, area, published_at
           ORDER BY src_id, src_line, rooms NULLS FIRST, floor NULLS FIRST,
                    building_type NULLS FIRST, copy_no) AS rn
  FROM listings),
silver AS (
  SELECT price, area + 0.0 AS area, rooms, floor, total_floors, address, building_type,
         try_strptime(published_at, '%Y-%m-%d %H:%M:%S') AS published_at,
         {oround('price / NULLIF(area, 0)')} AS price_per_sqm,
         NULLIF(district, '') AS district
  FROM ranked
  WHERE rn = 1 AND {VALID})"""

MART_DISTRICT = f"""mart_avg_price_by_district AS (
  SELECT district, {oavg('price')} AS avg_price,
         {oavg('price_per_sqm')} AS avg_price_per_sqm,
         count(*) AS listing_count
  FROM silver GROUP BY district)"""

MART_DAY = f"""mart_listings_by_day AS (
  SELECT CAST(published_at AS DATE) AS listing_date, count(*) AS listings_count,
         {oavg('price')} AS avg_price, {oavg('price_per_sqm')} AS avg_price_per_sqm
  FROM silver GROUP BY 1)"""

MART_ROOMS = f"""mart_avg_price_by_rooms AS (
  SELECT rooms, {oavg('price')} AS avg_price, {oavg('price_per_sqm')} AS avg_price_per_sqm,
         {oavg('area')} AS avg_area_sqm, count(*) AS listing_count
  FROM silver WHERE rooms IS NOT NULL AND rooms > 0 GROUP BY rooms)"""

MARTS = f"{SILVER},\n{MART_DISTRICT},\n{MART_DAY},\n{MART_ROOMS}"

SILVER_COLUMNS = (
    "price, area, rooms, floor, total_floors, address, building_type, "
    "CAST(published_at AS VARCHAR) AS published_at, price_per_sqm, district"
)
LISTING_COLUMNS = (
    "price, area, rooms, floor, total_floors, district, address, building_type, published_at"
)

# Whitespace class of Java's \s, spelled out for RE2.
WS = r"[ \t\n\v\f\r]"

ORACLE: dict[str, str] = {
    # ---- bronze --------------------------------------------------------------
    "bronze_parse": f"WITH {LISTINGS} SELECT {LISTING_COLUMNS} FROM sent",
    "bronze_events_json": (
        "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"
    ),
    "bronze_stream": f"WITH {LISTINGS} SELECT {LISTING_COLUMNS} FROM sent",
    "message_encode": f"""WITH {LISTINGS}
        SELECT {LISTING_COLUMNS}, rooms IS NULL AS rooms_sent_as_null FROM sent""",
    "csv_scan": """SELECT * REPLACE ('say "' || p_name || '", twice' || chr(10) || p_name AS p_name)
        FROM part""",
    "bronze_malformed": f"""WITH {LISTINGS}
        SELECT src_line,
               CASE WHEN src_line IN (2, 4, 5, 6, 7) THEN NULL ELSE price END AS price,
               CASE WHEN src_line IN (2, 4, 6, 7) THEN NULL ELSE area END AS area,
               CASE WHEN src_line IN (2, 3, 4, 6, 7) THEN NULL ELSE rooms END AS rooms,
               CASE WHEN src_line IN (2, 4, 6, 7) THEN NULL ELSE floor END AS floor,
               CASE WHEN src_line IN (2, 4, 6, 7) THEN NULL ELSE total_floors END AS total_floors,
               CASE WHEN src_line IN (2, 4, 6, 7) THEN NULL ELSE district END AS district,
               CASE WHEN src_line IN (2, 4, 6, 7) THEN NULL ELSE address END AS address,
               CASE WHEN src_line IN (2, 4, 6, 7) THEN NULL ELSE building_type END AS building_type,
               CASE WHEN src_line IN (2, 4, 6, 7) THEN NULL ELSE published_at END AS published_at
        FROM sent""",
    # ---- silver --------------------------------------------------------------
    "silver_dedup": f"""WITH {LISTINGS}
        SELECT DISTINCT district, address, {shown('price')} AS price, {shown('area')} + 0.0 AS area, published_at
        FROM listings""",
    "silver_dropna": f"""WITH {LISTINGS}
        SELECT DISTINCT district, address, price, area + 0.0 AS area, published_at FROM listings
        WHERE {VALID}""",
    "silver_types": f"""WITH {LISTINGS}
        SELECT {shown('price')} AS price, {shown('area')} AS area,
               CAST(rooms AS INT) AS rooms, CAST(floor AS INT) AS floor,
               CAST(total_floors AS INT) AS total_floors,
               published_at AS published_text,
               CAST(try_strptime(published_at, '%Y-%m-%d %H:%M:%S') AS VARCHAR) AS published_at
        FROM listings""",
    "silver_price_per_sqm": f"""WITH {LISTINGS}
        SELECT {shown('price')} AS price, {shown('area')} AS area, {shown('price_per_sqm')} AS price_per_sqm
        FROM (SELECT price, area, {oround('price / NULLIF(area, 0)')} AS price_per_sqm FROM listings)""",
    "silver_listings": f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver",
    "silver_partition_roundtrip": f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver",
    "silver_reappend": f"""WITH {LISTINGS},
        keyed AS (SELECT DISTINCT district, address, price, area, published_at,
                         (src_id + src_line + copy_no) % 2 + 1 AS run_no
                  FROM listings WHERE {VALID}),
        run1 AS (SELECT DISTINCT district, address, price, area, published_at
                 FROM keyed WHERE run_no = 1),
        run12 AS (SELECT DISTINCT district, address, price, area, published_at FROM keyed),
        appended AS (SELECT district FROM run1 UNION ALL SELECT district FROM run12)
        SELECT NULLIF(district, '') AS district, count(*) AS silver_rows
        FROM appended GROUP BY 1""",
    "silver_incremental": f"""WITH {SILVER}
        SELECT district, address, price, area, CAST(published_at AS VARCHAR) AS published_at, price_per_sqm
        FROM silver""",
    "silver_incremental_state": f"""WITH {SILVER}
        SELECT district, address, price, area, CAST(published_at AS VARCHAR) AS published_at, price_per_sqm
        FROM silver""",
    # ---- gold ----------------------------------------------------------------
    "gold_district": f"WITH {MARTS} SELECT * FROM mart_avg_price_by_district",
    "gold_daily": f"""WITH {MARTS}
        SELECT * REPLACE (CAST(listing_date AS VARCHAR) AS listing_date) FROM mart_listings_by_day""",
    "gold_rooms": f"WITH {MARTS} SELECT * FROM mart_avg_price_by_rooms",
    "gold_end_to_end": f"WITH {MARTS} SELECT * FROM mart_avg_price_by_district",
    "gold_merged": f"""WITH {MARTS}
        SELECT 'district' AS mart, district AS key, avg_price, avg_price_per_sqm, listing_count AS n
        FROM mart_avg_price_by_district
        UNION ALL SELECT 'day', CAST(listing_date AS VARCHAR), avg_price, avg_price_per_sqm, listings_count
        FROM mart_listings_by_day""",
    # ---- dashboard and SQL surface ---------------------------------------------
    "dash_top_districts": f"""WITH {MARTS}
        SELECT district, avg_price, avg_price_per_sqm, listing_count
        FROM mart_avg_price_by_district
        ORDER BY avg_price DESC NULLS LAST, district ASC NULLS LAST LIMIT 15""",
    "dash_daily": f"""WITH {MARTS}
        SELECT CAST(listing_date AS VARCHAR) AS listing_date, listings_count, avg_price
        FROM mart_listings_by_day""",
    "dash_rooms": f"""WITH {MARTS}
        SELECT rooms, avg_price, avg_price_per_sqm, listing_count FROM mart_avg_price_by_rooms
        ORDER BY rooms""",
    "sql_top5_sqm": f"""WITH {MARTS}
        SELECT district, avg_price_per_sqm FROM mart_avg_price_by_district
        ORDER BY avg_price_per_sqm DESC NULLS LAST, district ASC NULLS LAST LIMIT 5""",
    "sql_day_count": f"""WITH {MARTS}
        SELECT CAST(listing_date AS VARCHAR) AS listing_date, listings_count FROM mart_listings_by_day
        WHERE listing_date = (SELECT max(listing_date) - INTERVAL 1 DAY FROM mart_listings_by_day)""",
    "sql_two_room": f"""WITH {SILVER}
        SELECT district, {oavg('price')} AS avg_price, count(*) AS listing_count
        FROM silver WHERE rooms = 2 GROUP BY district""",
    "sql_preview": f"""WITH {MARTS}
        SELECT * REPLACE (CAST(listing_date AS VARCHAR) AS listing_date),
               (SELECT count(*) FROM mart_listings_by_day) AS total_rows
        FROM (FROM mart_listings_by_day ORDER BY listing_date NULLS LAST LIMIT 20)""",
    # ---- text ------------------------------------------------------------------
    "strip_fences": f"""WITH fenced AS (
          SELECT conv_id, turn,
                 CASE turn % 4
                   WHEN 0 THEN '```sql' || chr(10) || text || chr(10) || '```'
                   WHEN 1 THEN '  ```SQL ' || text || ' ```' || chr(10)
                   WHEN 2 THEN chr(9) || '```' || text || '```'
                   ELSE text || ' ``` mid ``` ' || text END AS raw
          FROM conversations),
        s1 AS (SELECT conv_id, turn, raw, regexp_replace(raw, '^{WS}+|{WS}+$', '', 'g') AS t FROM fenced),
        s2 AS (SELECT conv_id, turn, raw, regexp_replace(t, '^```(?:sql)?{WS}*', '', 'i') AS t FROM s1),
        s3 AS (SELECT conv_id, turn, raw, regexp_replace(t, '{WS}*```$', '') AS t FROM s2)
        SELECT conv_id, turn, raw, regexp_replace(t, '^{WS}+|{WS}+$', '', 'g') AS sql_text FROM s3""",
    # ---- pipeline metrics --------------------------------------------------------
    "stage_metrics": f"""WITH {LISTINGS},
        groups AS (SELECT district, address, price, area, published_at, count(*) AS n
                   FROM listings GROUP BY ALL)
        SELECT 'bronze_rows' AS stage, CAST(sum(n) AS BIGINT) AS row_count FROM groups
        UNION ALL SELECT 'dedup_rows', count(*) FROM groups
        UNION ALL SELECT 'valid_rows', count(*) FROM groups WHERE {VALID}
        UNION ALL SELECT 'silver_appended', count(*) FROM groups WHERE {VALID}""",
    "sample_exact": """SELECT CAST(round(count(*) * 0.1) AS BIGINT) AS sampled_rows,
        CAST(round(count(*) * 0.1) AS BIGINT) AS distinct_keys,
        CAST(round(count(*) * 0.1) AS BIGINT) AS known_keys,
        count(*) AS total_rows FROM lineitem""",
    # a CSV cannot tell '' from NULL
    "feed_messages": f"""WITH {LISTINGS}
        SELECT {LISTING_COLUMNS} FROM (SELECT * REPLACE (NULLIF(district, '') AS district,
          NULLIF(published_at, '') AS published_at) FROM sent)""",
}
