"""K7: gauges of streaming queries, read by a listener.

:func:`operators.latency.observe_latency` puts a named observation into a
stream; :class:`Gauges` collects what every micro-batch observed.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


class Gauges(StreamingQueryListener):
    """Observed values by query and batch.

    Add it with :meth:`attach` before a query starts.  Events come from
    another thread, a little after their batch; a batch that ran again keeps
    its last values."""

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._names: dict[str, str] = {}
        self._seen: dict[tuple[str, str, int], dict] = {}
        self._ended: dict[str, str | None] = {}

    def attach(self, spark: SparkSession) -> Gauges:
        self._spark = spark
        spark.streams.addListener(self)
        return self

    def detach(self) -> None:
        self._spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._names[str(event.id)] = event.name or str(event.id)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            for gauge, row in progress.observedMetrics.items():
                self._seen[self._names.get(str(progress.id), str(progress.id)), gauge, progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended[self._names.get(str(event.id), str(event.id))] = event.exception

    def series(self, gauge: str, query: str | None = None) -> list[tuple[int, dict]]:
        """(batch, values) of one gauge, by batch; batches that observed no row included."""
        with self._lock:
            return sorted(((b, v) for (q, g, b), v in self._seen.items() if g == gauge and query in (None, q)), key=lambda x: x[0])

    def ended(self) -> dict[str, str | None]:
        """Queries that have ended, with their error (None if they ended well)."""
        with self._lock:
            return dict(self._ended)

    def table(self, spark: SparkSession) -> DataFrame:
        """query, gauge, batch and the observed values as strings."""
        with self._lock:
            rows = [(q, g, b, {k: None if x is None else str(x) for k, x in v.items()}) for (q, g, b), v in self._seen.items()]
        return spark.createDataFrame(rows, "query string, gauge string, batch long, values map<string,string>")
