"""Running queries to their end, and counting what the watermark dropped."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

POLL_SECONDS = 0.2


def run_to_end(*queries: StreamingQuery) -> None:
    """Wait for queries that stop when caught up. The first failure of any of them
    is raised at once and stops the others, endless ones too."""
    waiting = list(queries)
    try:
        while waiting:
            for query in list(waiting):
                if query.awaitTermination(POLL_SECONDS):
                    waiting.remove(query)
    finally:
        for query in queries:
            query.stop()


def run_forever(spark: SparkSession) -> None:
    """Wait until any query ends, however it ends, and stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()


class LateRows(StreamingQueryListener):
    """Counts the rows each query run drops as late, report by report, so that the
    count is complete however many reports a run makes."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = defaultdict(int)
        self.batches: dict[str, dict[int, int]] = defaultdict(dict)
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        with self.changed:
            run = str(event.progress.runId)
            self.dropped[run] += late
            if event.progress.numInputRows:
                self.batches[run][event.progress.batchId] = late

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, query: StreamingQuery, seconds: float = 60) -> int:
        """The complete count of an ended run: reports arrive a little later than
        the run ends, and its end is reported last."""
        run = self._ended(query, seconds)
        return self.dropped[run]

    def by_batch(self, query: StreamingQuery, seconds: float = 60) -> list[int]:
        """The complete counts of an ended run's micro-batches with rows, in their order."""
        run = self._ended(query, seconds)
        return [late for _, late in sorted(self.batches[run].items())]

    def _ended(self, query: StreamingQuery, seconds: float) -> str:
        run = str(query.runId)
        with self.changed:
            if not self.changed.wait_for(lambda: run in self.ended, seconds):
                raise TimeoutError(f"the end of run {run} was not reported")
        return run


@contextmanager
def counting_late_rows(spark: SparkSession) -> Iterator[LateRows]:
    """Counts for all queries started inside."""
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)
