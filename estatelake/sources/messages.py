"""Message stream sources.

The production source is Kafka (``value`` bytes + broker ``timestamp``).  The
same pipeline runs offline on a directory of newline-delimited JSON files read
with the streaming ``text`` source; the file's modification time stands in for
the broker time.  Both return the columns ``value`` and ``timestamp``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Consumer options of the ingest job.
KAFKA_DEFAULTS = {
    "startingOffsets": "earliest",
    "failOnDataLoss": "false",
}


def kafka_messages(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming Kafka source (needs the ``spark-sql-kafka`` package on the classpath)."""
    opts = dict(KAFKA_DEFAULTS)
    opts.update(options or {})
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .options(**opts)
        .load()
    )
    return raw.select("value", "timestamp")


def file_messages(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming source over a directory of JSON-lines files (one message per line).

    ``max_files_per_trigger`` bounds each micro-batch, so that an
    ``availableNow`` run over a large backlog is split into batches of known size.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.load(path)
    return raw.select(
        F.col("value"), F.col("_metadata.file_modification_time").alias("timestamp")
    )


def read_messages(spark: SparkSession, fmt: str = "kafka", **kwargs) -> DataFrame:
    """Dispatch on the source format (``kafka`` or ``text``)."""
    if fmt == "kafka":
        return kafka_messages(spark, **kwargs)
    if fmt == "text":
        return file_messages(spark, **kwargs)
    raise ValueError(f"unsupported message source format: {fmt}")
