"""Progress monitoring (I5) and the run log derived from it (E14 input).

A ``StreamingQueryListener`` records one row per finished micro-batch and
one per terminated query. Only this small per-batch summary lives on the
driver; it is turned into a DataFrame with the ``RUN_LOG`` schema.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from siglake.schemas import RUN_LOG


def _parse_ts(s: str | None):
    if not s:
        return None
    return dt.datetime.fromisoformat(s.replace("Z", "+00:00")).replace(tzinfo=None)


class RunLogListener(StreamingQueryListener):
    """Collects batch progress (name, batch id, rows, duration) and failures.

    The driver keeps the rows (one per micro-batch) that ``flush`` has not yet
    appended to a run-log table, so a long-running job's history lives in
    storage, not in driver memory. A row leaves the driver only once written.
    """

    def __init__(self):
        self._lock = threading.Lock()
        self.rows: list = []
        self.failures: dict[str, str] = {}

    def onQueryStarted(self, event):  # noqa: N802 (Spark API name)
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        started = _parse_ts(p.timestamp)
        dur_ms = (p.durationMs or {}).get("triggerExecution", 0)
        finished = started + dt.timedelta(milliseconds=dur_ms) if started else None
        with self._lock:
            self.rows.append((f"{p.name}-{p.batchId}", p.name, "COMPLETED", started, finished,
                              int(p.numInputRows), None))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        if event.exception:
            with self._lock:
                self.failures[str(event.id)] = event.exception
                now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
                self.rows.append((f"{event.id}-failed", str(event.id), "FAILED", now, now, 0,
                                  event.exception))

    def run_log(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            rows = list(self.rows)
        return spark.createDataFrame(rows, RUN_LOG)

    def flush(self, spark: SparkSession, path: str, at_least: int = 1) -> int:
        """Append the buffered rows to the run-log table at ``path`` if there are enough; return how many.

        ``at_least`` keeps a job with short triggers from writing a file for every few rows.
        """
        with self._lock:
            rows = list(self.rows)
        if not rows or len(rows) < at_least:
            return 0
        spark.createDataFrame(rows, RUN_LOG).coalesce(1).write.mode("append").parquet(path)
        with self._lock:
            del self.rows[:len(rows)]
        return len(rows)


def attach(spark: SparkSession) -> RunLogListener:
    listener = RunLogListener()
    spark.streams.addListener(listener)
    return listener


def query_status(queries) -> list[dict]:
    """Status snapshot: name, active flag, last input rows, exception text."""
    out = []
    for q in queries:
        last = q.lastProgress or {}
        exc = q.exception() if not q.isActive else None
        out.append({"name": q.name, "active": q.isActive,
                    "last_input_rows": last.get("numInputRows", 0),
                    "exception": str(exc) if exc else None})
    return out
