"""What every micro-batch of a query has read, complete however many there were."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener


@dataclass(frozen=True)
class Batch:
    """A micro-batch: its number, rows read, duration, and metrics observed in its plan by name."""

    batch_id: int
    rows: int
    millis: int
    observed: dict[str, dict]


class BatchMetrics(StreamingQueryListener):
    """Collects the progress of the queries that run while it is attached (``with BatchMetrics(spark) as seen``).

    A query itself keeps its last hundred reports only.  Reports come in order and before the end of the query is
    told, so once that has come a query's list is complete.  A batch run again counts once, as last reported.
    """

    def __init__(self, spark: SparkSession):
        super().__init__()
        self._spark, self._lock = spark, threading.Lock()
        self._batches: dict[str, dict[int, Batch]] = {}
        self._over: dict[str, threading.Event] = {}

    def __enter__(self) -> BatchMetrics:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *fault) -> None:
        self._spark.streams.removeListener(self)

    def _ended(self, run: str) -> threading.Event:
        with self._lock:
            return self._over.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._ended(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {name: row.asDict() for name, row in p.observedMetrics.items()}
        with self._lock:
            held = self._batches.setdefault(str(p.runId), {})
            if p.batchId not in held or p.numInputRows:
                held[p.batchId] = Batch(p.batchId, p.numInputRows, p.batchDuration, observed)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended(str(event.runId)).set()

    def batches(self, query: StreamingQuery, seconds: float = 60) -> list[Batch]:
        """The batches of a query that has ended, in order."""
        if not self._ended(str(query.runId)).wait(seconds):
            raise TimeoutError(f"query {query.id} has not reported its end")
        with self._lock:
            return [b for _, b in sorted(self._batches.get(str(query.runId), {}).items())]

    def rows(self, query: StreamingQuery) -> int:
        return sum(b.rows for b in self.batches(query))
