"""Counts over all micro-batches of long backlogs."""

from __future__ import annotations

from estatelake.plans.pipeline import Layout, run_silver
from estatelake.sources.messages import file_messages
from estatelake.streaming.ingest import run_bronze
from estatelake.streaming.progress import ProgressTotals
from tests.test_append_log import bronze, day
from tests.test_streaming import message

FILES = 110


def test_listener_counts_every_micro_batch(spark, scratch):
    """110 files, one per micro-batch: the query itself remembers the last hundred only."""
    root = scratch("backlog")
    lines = [(message("A", float(i)),) for i in range(2 * FILES)]
    spark.createDataFrame(lines, "value string").repartition(FILES).write.text(f"{root}/inbox")
    with ProgressTotals(spark) as totals:
        query = run_bronze(file_messages(spark, f"{root}/inbox", max_files_per_trigger=1), f"{root}/bronze", f"{root}/_ck")
        seen = totals.of(query)
    assert seen.rows == 2 * FILES and seen.batches > 100
    assert sum(p["numInputRows"] for p in query.recentProgress) < 2 * FILES


def test_silver_reports_every_micro_batch(spark, scratch):
    """The report adds up the micro-batches themselves, so it needs no list of them."""
    layout = Layout(scratch("long_report"))
    rows = bronze(spark, [(float(i // 2), "A", day(1)) for i in range(8)])
    rows.coalesce(1).write.option("maxRecordsPerFile", 2).parquet(layout.bronze)
    report = run_silver(spark, layout, "state", max_files_per_trigger=1)
    assert report == {"bronze_rows": 8, "dedup_rows": 4, "valid_rows": 4, "silver_appended": 4}
