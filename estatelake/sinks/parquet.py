"""Parquet sinks: partitioned append of silver, overwrite of marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from estatelake.sinks import versions


def append_partitioned(df: DataFrame, path: str, partition_col: str = "district") -> None:
    """Append ``df`` to a Parquet folder partitioned by ``partition_col``.

    A ``REBALANCE`` on the partition column puts each district's rows into few
    tasks (few files per district and run) while AQE still splits a district
    that holds a large share of the rows and merges the small ones, so one hot
    district does not end up in a single writer task.
    """
    (
        df.hint("rebalance", partition_col)
        .write.mode("append")
        .partitionBy(partition_col)
        .parquet(path)
    )


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a mart folder; AQE sizes its files (a ``REBALANCE`` merges small partitions and splits large ones)."""
    df.hint("rebalance").write.mode("overwrite").parquet(path)


class MartStore:
    """The marts of one run, shown together: written to a fresh version, readers see it with ``show``."""

    def __init__(self, spark: SparkSession, gold_path: str):
        self.spark, self.root, self.version = spark, gold_path, versions.fresh(gold_path)

    def write(self, name: str, mart: DataFrame) -> None:
        overwrite(mart, f"{self.version}/{name}")

    def show(self) -> None:
        versions.flip(self.spark, self.root, self.version)
