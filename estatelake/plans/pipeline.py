"""Batch pipeline driver: bronze → silver → gold, in order, with stage counts.

Each step is a Spark job over files in the shared folder; a failed or lost
run is repeated from the checkpoints (bronze offsets, silver stream state).
The marts are made anew from silver, or merged from the sums kept per append, and
change together when all of them are written, so repeating a run is safe.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from estatelake.operators.marts import marts_aggregate, merge_partials, split_marts
from estatelake.session import fine_splits, lean_shuffles
from estatelake.sinks.jdbc import JdbcMarts
from estatelake.sinks.parquet import MartStore
from estatelake.sources.files import read_silver
from estatelake.streaming.append_log import AppendLog
from estatelake.streaming.incremental import refine_batch, run_incremental_silver, run_state_silver
from estatelake.streaming.ingest import run_bronze
from estatelake.streaming.progress import ProgressTotals


@dataclass(frozen=True)
class Layout:
    """Folder layout of one lakehouse below a shared root."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/listings"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/listings"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    def checkpoint(self, stage: str) -> str:
        """Checkpoint of one stage; each streaming silver mode has its own (``silver-stream``, ``silver-state``)."""
        return f"{self.root}/checkpoints/{stage}"


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row-count observation; it is filled by the job that consumes ``df``."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def run_gold(
    spark: SparkSession,
    layout: Layout,
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    mode: str = "full",
) -> dict[str, int]:
    """Make all marts and replace the stored ones at once (Parquet, or JDBC if a URL is given).

    The three marts come from one grouping-sets aggregate.  ``mode="full"`` computes it by one scan of
    silver; ``"merge"`` adds up the sums and counts that every append has left beside silver
    (``AppendLog.partials``), so its cost follows the groups and not silver.  The first merge scans
    silver once.  The aggregate holds one row per group, so it is persisted and the
    three writes read it.
    """
    if mode == "full":
        silver, seen = counted(read_silver(spark, layout.silver), "silver_rows")
        agg = marts_aggregate(silver).persist()
    elif mode == "merge":
        with lean_shuffles(spark):
            agg = merge_partials(AppendLog(spark, layout.silver).partials()).persist()
    else:
        raise ValueError(f"unknown gold mode: {mode}")
    store = JdbcMarts(spark, jdbc_url, jdbc_properties) if jdbc_url else MartStore(spark, layout.gold)
    counts: dict[str, int] = {}
    try:
        with fine_splits(spark), lean_shuffles(spark):
            for name, df in split_marts(agg).items():
                df, written = counted(df, name)
                store.write(name, df)
                counts[name] = int(written.get.get("rows", 0))
            if mode == "full":
                counts["silver_rows"] = int(seen.get.get("rows", 0))
            else:  # each row of silver is in one district's group
                counts["silver_rows"] = split_marts(agg)["mart_avg_price_by_district"].agg(F.sum("listing_count")).first()[0] or 0
        store.show()
    finally:
        agg.unpersist()
    return counts


def run_silver(
    spark: SparkSession,
    layout: Layout,
    mode: str = "stream",
    max_files_per_trigger: int | None = None,
) -> dict[str, int]:
    """One silver run; returns the counts of its stages.

    ``mode``: ``"stream"`` (incremental with an anti join against silver,
    each key once), ``"state"`` (incremental with the seen keys in the streaming
    state store), ``"new_only"`` (batch, same result as ``"stream"``) or
    ``"reappend"`` (the reference's behaviour).  Counts: rows read from bronze, left
    by the dedup, left by the null filter, appended, each added up over all micro-batches.  In ``"state"`` mode the null filter
    comes first, so rows read and rows left by both are what can be told apart.
    """
    report = {"bronze_rows": 0, "dedup_rows": 0, "valid_rows": 0, "silver_appended": 0}
    if mode in ("stream", "state"):
        run = run_incremental_silver if mode == "stream" else run_state_silver
        run(
            spark, layout.bronze, layout.silver, layout.checkpoint(f"silver-{mode}"),
            max_files_per_trigger=max_files_per_trigger, report=report,
        )
    else:
        refine_batch(spark, layout.bronze, layout.silver, mode, report=report)
    return report


def run_pipeline(
    spark: SparkSession,
    messages: DataFrame,
    layout: Layout,
    silver_mode: str = "stream",
    jdbc_url: str | None = None,
    jdbc_properties: dict[str, str] | None = None,
    lenient_ints: bool = False,
    max_files_per_trigger: int | None = None,
    gold_mode: str = "full",
) -> dict[str, int]:
    """One scheduled run: ingest → refine → marts.  Returns stage row counts (``messages``: those that came in)."""
    with ProgressTotals(spark) as totals:
        query = run_bronze(messages, layout.bronze, layout.checkpoint("bronze"), lenient_ints=lenient_ints)
        report = {"messages": totals.of(query).rows}
    report.update(run_silver(spark, layout, silver_mode, max_files_per_trigger))
    report.update(run_gold(spark, layout, jdbc_url, jdbc_properties, gold_mode))
    return report
