"""Watching running feeds: what every batch took in, and the end of the first one that ends."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRICS = "feed"
BATCHES = "feed string, query string, batch long, rows long, rejects long"


def observed(changes: DataFrame, name: str = METRICS) -> DataFrame:
    """Parsed changes that count themselves, and the unusable among them, while the batch runs: there is no job for it."""
    return changes.observe(name, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("problem").isNotNull()).alias("rejects"))


class FeedMetrics(StreamingQueryListener):
    """Rows and rejects of each batch of the observed feeds of a session.

    It keeps the last ``keep`` batches; ``on_batch`` is told of every one, to hand it to a monitoring system.
    """

    def __init__(self, keep: int = 10_000, on_batch=None):
        self.keep, self.on_batch = keep, on_batch
        self.batches: list[tuple[str, str, int, int, int]] = []
        self.ended: dict[str, str | None] = {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(METRICS)
        if found is None or not found["rows"]:
            return
        line = (progress.name, str(progress.id), progress.batchId, found["rows"], found["rejects"])
        with self._changed:
            self.batches = [*self.batches, line][-self.keep:]
        if self.on_batch:
            self.on_batch(*line)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self.ended[str(event.id)] = event.exception
            self._changed.notify_all()

    def wait_for(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all that a query that has ended reported has arrived; its end is reported last."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.id) in self.ended, seconds):
                raise TimeoutError(f"no word of the end of {query.name}")

    def frame(self, spark: SparkSession) -> DataFrame:
        """The batches kept, as a table."""
        return spark.createDataFrame(list(self.batches), BATCHES)


def watch(spark: SparkSession, **options) -> FeedMetrics:
    """Begin to watch the feeds of a session."""
    metrics = FeedMetrics(**options)
    spark.streams.addListener(metrics)
    return metrics


def await_first(spark: SparkSession, queries: Sequence[StreamingQuery], poll: float = 5.0) -> StreamingQuery:
    """Wait until one of the feeds ends, stop the others, and return it; if it failed, its error is raised.

    A warehouse that lost one of its feeds is no longer what its readers take it for, so none goes on alone.
    """
    if not queries:
        raise ValueError("no feeds to wait for")
    try:
        while all(q.isActive for q in queries):
            spark.streams.resetTerminated()
            if all(q.isActive for q in queries):  # one that ended before the reset is not waited for
                spark.streams.awaitAnyTermination(int(poll) or 1)
    except Exception:  # of any query of the session; the feeds' own errors are raised below
        if all(q.isActive for q in queries):
            raise
    finally:
        ended = [q for q in queries if not q.isActive]
        for query in queries:
            if query.isActive:
                query.stop()
    failed = next((q for q in ended if q.exception() is not None), None)
    if failed is not None:
        raise failed.exception()
    return ended[0]
