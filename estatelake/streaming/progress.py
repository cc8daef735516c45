"""Totals over all micro-batches of a streaming query.

``StreamingQuery.recentProgress`` holds the last hundred micro-batches only; a listener hears of every one.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


@dataclass
class Totals:
    """What one run of a query has done."""

    batches: int = 0
    rows: int = 0
    ended: threading.Event = field(default_factory=threading.Event)


class ProgressTotals(StreamingQueryListener):
    """Adds up rows and micro-batches per run of a query, while it is open as a context."""

    WAIT_SECONDS = 60.0  # for the events of a run that has ended

    def __init__(self, spark: SparkSession):
        self._spark, self._runs, self._lock = spark, {}, threading.Lock()

    def __enter__(self) -> ProgressTotals:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_exc) -> None:
        self._spark.streams.removeListener(self)

    def _run(self, run_id: object) -> Totals:
        with self._lock:
            return self._runs.setdefault(str(run_id), Totals())

    def of(self, query: StreamingQuery) -> Totals:
        """The totals of a run that has ended; events come in their order, the end last."""
        totals = self._run(query.runId)
        if not totals.ended.wait(self.WAIT_SECONDS):
            raise TimeoutError(f"no end of run {query.runId} was heard of in {self.WAIT_SECONDS:.0f} s")
        return totals

    def onQueryStarted(self, event) -> None:
        self._run(event.runId)

    def onQueryProgress(self, event) -> None:
        totals = self._run(event.progress.runId)
        if event.progress.numInputRows:
            totals.rows += event.progress.numInputRows
            totals.batches += 1

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._run(event.runId).ended.set()
