"""Notes of the batches that streaming queries have run."""

from __future__ import annotations

import threading
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

BATCH_NOTE = "query string, batch_id bigint, started timestamp, rows bigint, milliseconds bigint"


class BatchNotes(StreamingQueryListener):
    """Keeps a short note of each batch, of up to ``last`` batches.

    Use as ``with BatchNotes(spark) as notes``; notes of a query come a little after its batches, so :meth:`wait` for them.
    """

    def __init__(self, spark: SparkSession, last: int = 10_000):
        self.spark, self.last = spark, last
        self.rows: list[tuple] = []
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def __enter__(self) -> BatchNotes:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        told = event.progress
        started = datetime.fromisoformat(told.timestamp.replace("Z", "+00:00"))
        note = (str(told.runId), told.batchId, started, told.numInputRows, int(told.batchDuration))
        with self.changed:
            self.rows = [*self.rows, note][-self.last :]
            self.changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the end of a query that was stopped is noted; all its batches are noted before."""
        until = time.monotonic() + seconds
        with self.changed:
            while str(query.runId) not in self.ended:
                if not self.changed.wait(until - time.monotonic()):
                    raise TimeoutError(f"no note of the end of {query.runId}")

    def of(self, query: StreamingQuery) -> list[tuple]:
        """Batches of a query with rows, in order: ``(batch, start in ms, rows)``."""
        with self.changed:
            found = [(r[1], round(r[2].timestamp() * 1000), r[3]) for r in self.rows if r[0] == str(query.runId)]
        return sorted(r for r in found if r[2])

    def table(self) -> DataFrame:
        with self.changed:
            return self.spark.createDataFrame(self.rows, BATCH_NOTE)


def on_time(batches: list[tuple], interval_ms: int) -> list[tuple[int, bool]]:
    """Of each batch whether it began no sooner than the first multiple of the interval after the start of the one before."""
    before = [None, *(start for _, start, _ in batches)]
    return [(batch, last is None or start >= (last // interval_ms + 1) * interval_ms) for (batch, start, _), last in zip(batches, before)]
