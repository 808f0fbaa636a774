"""Sums over all batches of a stream's run, however many there are."""

from __future__ import annotations

import threading
from collections import Counter

from pyspark.sql import SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener


class RunLog(StreamingQueryListener):
    """Rows, batches, seconds and observed counts of each run, by its id. A query keeps the progress of its last batches only; this keeps sums."""

    def __init__(self):
        self.sums: dict[str, Counter] = {}
        self.ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _of(self, run: str) -> tuple[Counter, threading.Event]:
        with self._lock:
            return self.sums.setdefault(run, Counter()), self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._of(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        sums, _ = self._of(str(p.runId))
        sums.update({"rows": p.numInputRows, "batches": 1, "milliseconds": p.durationMs.get("triggerExecution", 0)})
        for metrics in p.observedMetrics.values():
            sums.update({f"observed.{k}": v for k, v in metrics.asDict().items() if v is not None})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._of(str(event.runId))[1].set()

    def wait(self, run: str, seconds: float = 60) -> Counter:
        """The sums of a run once its end has been told; events come in order, so nothing follows."""
        sums, ended = self._of(run)
        if not ended.wait(seconds):
            raise TimeoutError("the end of the stream was not reported")
        return sums


def listening(spark: SparkSession) -> RunLog:
    log = RunLog()
    spark.streams.addListener(log)
    return log
