"""A counter of the rows that pass a point of a running query."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


class RowCounter(StreamingQueryListener):
    """Adds up what micro-batches report; a micro-batch that runs again after a restart counts once.

    Register it with ``spark.streams.addListener``; ``total`` may be read while queries run.
    """

    def __init__(self, name: str) -> None:
        self.name = name
        self.batches: dict[tuple[str, int], int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def counted(self, stream: DataFrame) -> DataFrame:
        """The stream, with its rows counted here."""
        return stream.observe(self.name, F.count(F.lit(1)).alias("count"))

    @property
    def total(self) -> int:
        with self._change:
            return sum(self.batches.values())

    def wait_for(self, run_id: str, seconds: float = 60) -> bool:
        """Reports come after the fact: wait until those of a run that has ended are all here."""
        with self._change:
            return self._change.wait_for(lambda: run_id in self._ended, seconds)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            with self._change:
                self.batches[str(event.progress.id), event.progress.batchId] = seen["count"]

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()
