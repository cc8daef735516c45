"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the listings adapter or
directly) and runs the library's stages over all of their rows.  Lineage
stamps (load times, send times) are left out of compared output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.functions.exact import round2, safe_ratio
from estatelake.functions.text import strip_fences
from estatelake.operators import marts as M
from estatelake.operators import messages
from estatelake.operators.refine import deduplicate, drop_incomplete, normalize_types, refine
from estatelake.operators.sample import exact_sample
from estatelake.plans import sqlapi
from estatelake.plans.feed import publish_from_csv
from estatelake.plans.pipeline import Layout, run_pipeline, run_silver
from estatelake.schemas import DEDUP_KEY
from estatelake.session import lean_shuffles, scratch_path
from estatelake.sinks.messages import TEXT_FILES, write_messages
from estatelake.sinks.parquet import MartStore, append_partitioned
from estatelake.sources.files import read_bronze, read_csv, read_mart, read_silver
from estatelake.sources.listings import COPY_EVERY, as_bronze, bronze_listings, listings, read_table
from estatelake.sources.messages import file_messages
from estatelake.streaming.incremental import refine_batch, run_incremental_silver, run_state_silver
from estatelake.streaming.ingest import run_bronze

# Survivor order of a duplicate group for compared output (a total order).
SURVIVOR_ORDER = ["src_id", "src_line", "rooms", "floor", "building_type"]

LISTING_COLUMNS = [
    "price", "area", "rooms", "floor", "total_floors",
    "district", "address", "building_type", "published_at",
]
SILVER_COLUMNS = [
    "price", "area", "rooms", "floor", "total_floors", "address",
    "building_type", "published_at", "price_per_sqm", "district",
]

Query = Callable[[SparkSession, str], DataFrame]


def run_no() -> F.Column:
    """Which of two runs delivers a listing: every row is delivered exactly once,
    and the second copy of a listing goes in the other run than the first."""
    return (F.col("src_id") + F.col("src_line") + F.col("copy_no")) % 2 + 1


# Corruption applied to a message, by its line number (1 = none).
#   2 cut short, 3 rooms sent as 2.0, 4 wrapped in an array,
#   5 key PRICE in capitals, 6 not JSON, 7 empty message
CORRUPTIONS = {2: "truncated", 3: "rooms_float", 4: "array", 5: "key_case", 6: "not_json", 7: "empty"}
_CODE = {name: code for code, name in CORRUPTIONS.items()}


# ---- shared stage builders ---------------------------------------------------------

def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver over the whole adapter with the deterministic survivor."""
    return refine(bronze_listings(spark, sf_dir), order_by=SURVIVOR_ORDER)


def marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return M.build_marts(silver(spark, sf_dir))


def _with_marts(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Store the named marts (or silver) and register them under the dashboard's table names.

    The panels and SQL read what a pipeline run has stored; nothing is derived again per panel.
    """
    layout = Layout(scratch_path(spark, "marts"))
    refined = silver(spark, sf_dir)
    stored = [name for name in names if name != "silver_listings"]
    if stored:
        store = MartStore(spark, layout.gold)
        for name in stored:
            store.write(name, M.build_marts(refined)[name])
        store.show()
    tables = {name: read_mart(spark, layout.gold, name) for name in stored}
    if "silver_listings" in names:
        append_partitioned(refined, layout.silver)
        tables["silver_listings"] = read_silver(spark, layout.silver)
    sqlapi.register(tables)


def _sql(spark: SparkSession, sf_dir: str, sql: str, *names: str) -> DataFrame:
    _with_marts(spark, sf_dir, *names)
    df, err = sqlapi.run_sql(spark, sql)
    if err:
        raise RuntimeError(err)
    return df


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Times as text: the fixture has the years 1 and 9999, which not every reader of results holds."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """NaN as -1: not every reader of results tells it from NULL."""
    return df.withColumns({c: F.nanvl(c, F.lit(-1.0)) for c in columns})


# ---- bronze ----------------------------------------------------------------------

def q_bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records → JSON messages → typed bronze fields (X1 X2 P1 P2)."""
    msgs = messages.encode(listings(spark, sf_dir))
    return messages.parse(msgs.select(F.col("value").cast("binary").alias("value")),
                          time_col=None).select(*LISTING_COLUMNS)


def q_bronze_events_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``from_json`` on a JSON column that exists in the data: ``events.props``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_id", F.from_json("props", "k INT").getField("k").alias("k")
    )


def q_message_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer data step: NaN → null, JSON with nulls kept; parsed back."""
    msgs = messages.encode(listings(spark, sf_dir))
    flagged = msgs.withColumn(
        "rooms_sent_as_null", F.col("value").contains('"rooms":null')
    )
    return messages.parse(flagged, time_col=None, keep=("rooms_sent_as_null",)).select(
        *LISTING_COLUMNS, "rooms_sent_as_null"
    )


def corrupt(value: F.Column, kind: F.Column) -> F.Column:
    """Damage a JSON message in one of the ``CORRUPTIONS`` ways (other kinds: intact)."""
    return (
        F.when(kind == _CODE["truncated"], value.substr(F.lit(1), F.length(value) - 5))
        .when(kind == _CODE["rooms_float"],
              F.regexp_replace(value, r'"rooms":(-?[0-9]+)', '"rooms":$1.0'))
        .when(kind == _CODE["array"], F.concat(F.lit("["), value, F.lit("]")))
        .when(kind == _CODE["key_case"], F.regexp_replace(value, '"price":', '"PRICE":'))
        .when(kind == _CODE["not_json"], F.regexp_replace(value, "^[{]", "("))
        .when(kind == _CODE["empty"], F.lit(""))
        .otherwise(value)
    )


def q_bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages are kept as rows: all-NULL, or NULL in the damaged field."""
    msgs = messages.encode(listings(spark, sf_dir), keep=("src_line",))
    damaged = msgs.withColumn("value", corrupt(F.col("value"), F.col("src_line")))
    return messages.parse(damaged, time_col=None, keep=("src_line",)).select(
        "src_line", *LISTING_COLUMNS
    )


def listings_of_run(spark: SparkSession, sf_dir: str, run: int) -> DataFrame:
    """The listings that one of two runs delivers.

    The first filter says what the second implies for a listing that is sent once.  It reads no copy number, so
    Catalyst moves it below the copies, the join and the dirt rules.
    """
    src_id, once = F.col("src_id"), (F.col("src_id") + F.col("src_line")) % 2 + 1
    may_go = listings(spark, sf_dir).where((src_id % COPY_EVERY == 0) | (once == run))
    return may_go.where(run_no() == run)


def _deliver(spark: SparkSession, sf_dir: str, inbox: str, run: int) -> None:
    """Land the messages of one run as JSON-lines files in the inbox folder."""
    write_messages(messages.encode(listings_of_run(spark, sf_dir, run)), "text", inbox)


def q_bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ``availableNow`` runs of the ingest over files arriving in between."""
    root = scratch_path(spark, "bronze_stream")
    for run in (1, 2):
        _deliver(spark, sf_dir, f"{root}/inbox", run)
        run_bronze(file_messages(spark, f"{root}/inbox"), f"{root}/bronze", f"{root}/_ck_bronze")
    return read_bronze(spark, f"{root}/bronze").select(*LISTING_COLUMNS)


def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV in another column order, with doubled quotes and line breaks in fields, read by its declared schema."""
    part = read_table(spark, sf_dir, "part")
    path = scratch_path(spark, "csv_scan")
    said = F.concat(F.lit('say "'), "p_name", F.lit('", twice\n'), "p_name")
    shuffled = part.withColumn("p_name", said).select(*reversed(part.columns))
    shuffled.write.options(header="true", escape='"').csv(path)
    return read_csv(spark, path, part.schema, multiline=True)


def q_feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed step over a listing CSV, with all rows sent."""
    root = scratch_path(spark, "feed")
    sent = listings(spark, sf_dir)
    with lean_shuffles(spark):
        sent.write.options(header="true", escape='"', **TEXT_FILES).csv(f"{root}/csv")
    publish_from_csv(spark, f"{root}/csv", fraction=1.0, fmt="text", path=f"{root}/inbox")
    received = spark.read.text(f"{root}/inbox")
    return messages.parse(received, time_col=None).select(*LISTING_COLUMNS)


def q_sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 10 % sample of lineitem: its size, its distinct keys, and those that the table holds."""
    li = read_table(spark, sf_dir, "lineitem")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
    listed = ", ".join(key)
    sampled = exact_sample(li, 0.1, key=key, seed=42)
    return spark.sql(
        "SELECT (SELECT count(*) FROM {s}) AS sampled_rows, "
        f"(SELECT count(DISTINCT {listed}) FROM {{s}}) AS distinct_keys, "
        f"(SELECT count(*) FROM {{s}} LEFT SEMI JOIN {{t}} USING ({listed})) AS known_keys, "
        "(SELECT count(*) FROM {t}) AS total_rows",
        s=sampled.select(*key),
        t=li.select(*key),
    )


# ---- silver ----------------------------------------------------------------------

def q_silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(deduplicate(listings(spark, sf_dir), DEDUP_KEY).select(*DEDUP_KEY), "price", "area")


def q_silver_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_incomplete(deduplicate(listings(spark, sf_dir), DEDUP_KEY)).select(*DEDUP_KEY)


def q_silver_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    recs = listings(spark, sf_dir).withColumn("published_text", F.col("published_at"))
    out = normalize_types(recs).select(
        "price", "area", "rooms", "floor", "total_floors", "published_text", "published_at"
    )
    return as_text(shown(out, "price", "area"), "published_at")


def q_silver_price_per_sqm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = listings(spark, sf_dir).select(
        "price", "area", round2(safe_ratio("price", "area")).alias("price_per_sqm")
    )
    return shown(out, "price", "area", "price_per_sqm")


def q_silver_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(silver(spark, sf_dir).select(*SILVER_COLUMNS), "published_at")


def q_silver_partition_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written partitioned by district and read back with its schema."""
    path = scratch_path(spark, "silver_roundtrip")
    append_partitioned(silver(spark, sf_dir), path)
    return as_text(read_silver(spark, path).select(*SILVER_COLUMNS), "published_at")


def q_silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of stream ingest + incremental silver; each key lands once."""
    root = scratch_path(spark, "silver_incremental")
    for run in (1, 2):
        _deliver(spark, sf_dir, f"{root}/inbox", run)
        run_bronze(file_messages(spark, f"{root}/inbox"), f"{root}/bronze", f"{root}/_ck_bronze")
        run_incremental_silver(
            spark, f"{root}/bronze", f"{root}/silver", f"{root}/_ck_silver",
            order_by=["rooms", "floor", "total_floors", "building_type"],
        )
    out = read_silver(spark, f"{root}/silver").select(
        "district", "address", "price", "area", "published_at", "price_per_sqm"
    )
    return as_text(out, "published_at")


def q_silver_incremental_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of stream ingest + state-store silver (seen keys kept as streaming state)."""
    root = scratch_path(spark, "silver_incremental_state")
    for run in (1, 2):
        _deliver(spark, sf_dir, f"{root}/inbox", run)
        run_bronze(file_messages(spark, f"{root}/inbox"), f"{root}/bronze", f"{root}/_ck_bronze")
        run_state_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/_ck_silver")
    out = read_silver(spark, f"{root}/silver").select(
        "district", "address", "price", "area", "published_at", "price_per_sqm"
    )
    return as_text(out, "published_at")


def q_silver_reappend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's batch silver: all of bronze refined and appended on every run."""
    root = scratch_path(spark, "silver_reappend")
    recs = listings(spark, sf_dir)
    for run in (1, 2):
        as_bronze(recs.where(run_no() == run)).drop("src_id", "src_line", "copy_no") \
            .write.mode("append").parquet(f"{root}/bronze")
        refine_batch(spark, f"{root}/bronze", f"{root}/silver", mode="reappend")
    return (
        read_silver(spark, f"{root}/silver")
        .groupBy("district")
        .agg(F.count(F.lit(1)).alias("silver_rows"))
    )


# ---- gold ------------------------------------------------------------------------

def q_gold_district(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mart_by_district(silver(spark, sf_dir))


def q_gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(M.mart_by_day(silver(spark, sf_dir)), "listing_date")


def q_gold_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.mart_by_rooms(silver(spark, sf_dir))


def q_gold_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages → stream ingest → incremental silver → one-pass marts → storage.

    Returns the district mart as written.  It depends on dedup keys only, so the
    arbitrary survivor of the streaming path does not change it.
    """
    layout = Layout(scratch_path(spark, "end_to_end"))
    inbox = f"{layout.root}/inbox"
    write_messages(messages.encode(listings(spark, sf_dir)), "text", inbox)
    run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode="stream")
    return read_mart(spark, layout.gold, "mart_avg_price_by_district")


def q_gold_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the whole pipeline, the marts merged from the sums of each run's new rows.

    The first run's merge reads silver once; the second reads the sums only.  Returns the district and day
    marts as stored, which do not depend on the arbitrary survivor of the streaming path.
    """
    layout = Layout(scratch_path(spark, "gold_merged"))
    for run in (1, 2):
        _deliver(spark, sf_dir, f"{layout.root}/inbox", run)
        run_pipeline(spark, file_messages(spark, f"{layout.root}/inbox"), layout, gold_mode="merge")
    by_district = read_mart(spark, layout.gold, "mart_avg_price_by_district")
    by_day = read_mart(spark, layout.gold, "mart_listings_by_day")
    columns = ["avg_price", "avg_price_per_sqm"]
    return by_district.select(F.lit("district").alias("mart"), F.col("district").alias("key"), *columns, F.col("listing_count").alias("n")).union(
        by_day.select(F.lit("day"), F.col("listing_date").cast("string"), *columns, "listings_count")
    )


# ---- dashboard and SQL surface ---------------------------------------------------------

def q_dash_top_districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, sqlapi.DASH_TOP_DISTRICTS, "mart_avg_price_by_district")


def q_dash_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_text(_sql(spark, sf_dir, sqlapi.DASH_DAILY, "mart_listings_by_day"), "listing_date")


def q_dash_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, sqlapi.DASH_ROOMS, "mart_avg_price_by_rooms")


def q_sql_top5_sqm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, sqlapi.TOP5_PRICE_PER_SQM, "mart_avg_price_by_district")


def q_sql_day_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_marts(spark, sf_dir, "mart_listings_by_day")
    return as_text(sqlapi.day_count(spark), "listing_date")


def q_sql_two_room(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, sqlapi.TWO_ROOM_BY_DISTRICT, "silver_listings")


def q_sql_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_marts(spark, sf_dir, "mart_listings_by_day")
    df, err = sqlapi.preview(
        spark, "SELECT * FROM mart_listings_by_day ORDER BY listing_date ASC NULLS LAST -- by day"
    )
    if err:
        raise RuntimeError(err)
    return as_text(df, "listing_date")


# ---- text ------------------------------------------------------------------------

def fenced_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model-style answers: every conversation turn wrapped in a different fence style."""
    conv = read_table(spark, sf_dir, "conversations")
    t = F.col("text")
    nl, tab = F.lit("\n"), F.lit("\t")
    raw = (
        F.when(F.col("turn") % 4 == 0, F.concat(F.lit("```sql"), nl, t, nl, F.lit("```")))
        .when(F.col("turn") % 4 == 1, F.concat(F.lit("  ```SQL "), t, F.lit(" ```"), nl))
        .when(F.col("turn") % 4 == 2, F.concat(tab, F.lit("```"), t, F.lit("```")))
        .otherwise(F.concat(t, F.lit(" ``` mid ``` "), t))
    )
    return conv.select("conv_id", "turn", raw.alias("raw"))


def q_strip_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fenced_conversations(spark, sf_dir)
    return df.select("conv_id", "turn", "raw", strip_fences("raw").alias("sql_text"))


# ---- pipeline metrics --------------------------------------------------------------

def q_stage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that a silver run reports of its own stages, one row for each."""
    layout = Layout(scratch_path(spark, "stage_metrics"))
    as_bronze(listings(spark, sf_dir)).drop("src_id", "src_line", "copy_no").write.parquet(layout.bronze)
    report = run_silver(spark, layout)
    return spark.createDataFrame(sorted(report.items()), "stage string, row_count long")


QUERIES: dict[str, Query] = {
    "bronze_parse": q_bronze_parse,
    "bronze_events_json": q_bronze_events_json,
    "bronze_malformed": q_bronze_malformed,
    "bronze_stream": q_bronze_stream,
    "message_encode": q_message_encode,
    "csv_scan": q_csv_scan,
    "feed_messages": q_feed_messages,
    "sample_exact": q_sample_exact,
    "silver_dedup": q_silver_dedup,
    "silver_dropna": q_silver_dropna,
    "silver_types": q_silver_types,
    "silver_price_per_sqm": q_silver_price_per_sqm,
    "silver_listings": q_silver_listings,
    "silver_partition_roundtrip": q_silver_partition_roundtrip,
    "silver_incremental": q_silver_incremental,
    "silver_incremental_state": q_silver_incremental_state,
    "silver_reappend": q_silver_reappend,
    "gold_district": q_gold_district,
    "gold_daily": q_gold_daily,
    "gold_rooms": q_gold_rooms,
    "gold_end_to_end": q_gold_end_to_end,
    "gold_merged": q_gold_merged,
    "dash_top_districts": q_dash_top_districts,
    "dash_daily": q_dash_daily,
    "dash_rooms": q_dash_rooms,
    "sql_top5_sqm": q_sql_top5_sqm,
    "sql_day_count": q_sql_day_count,
    "sql_two_room": q_sql_two_room,
    "sql_preview": q_sql_preview,
    "strip_fences": q_strip_fences,
    "stage_metrics": q_stage_metrics,
}
