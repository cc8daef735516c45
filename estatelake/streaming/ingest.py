"""Bronze ingest: message stream → append-only Parquet, exactly once per file/offset.

``trigger(availableNow=True)`` drains everything that arrived since the last
checkpoint (in bounded micro-batches when the source has a per-trigger limit)
and stops, so a scheduler can run the job periodically.  The Parquet file sink
records committed files in ``_spark_metadata``; readers that go through it
(batch or stream) never see files of a failed attempt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from estatelake.operators.messages import parse
from estatelake.session import fine_splits


def start_bronze(
    messages: DataFrame,
    bronze_path: str,
    checkpoint: str,
    lenient_ints: bool = False,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the ingest query (``value``/``timestamp`` stream → bronze rows)."""
    rows = parse(messages, "value", "timestamp", lenient_ints=lenient_ints)
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", bronze_path)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_bronze(messages: DataFrame, bronze_path: str, checkpoint: str, **kwargs) -> StreamingQuery:
    """Drain the backlog into bronze and wait for the end of the run."""
    with fine_splits(messages.sparkSession):  # packed text: few bytes a message
        query = start_bronze(messages, bronze_path, checkpoint, available_now=True, **kwargs)
        query.awaitTermination()
    return query
