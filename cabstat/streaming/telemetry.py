"""Progress telemetry as rows: a listener turns each progress event into one
row (query id, sink, durations, rates, input rows, observed malformed counts,
RFC 1123 date); a termination with an error becomes a row too."""

from __future__ import annotations

import datetime as dt
import logging
import threading
import time
import traceback

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

# Names of the metric fields.
PROGRESS_DDL = ("id STRING, run_id STRING, name STRING, batch_id BIGINT, sink STRING, "
                "durationms MAP<STRING, BIGINT>, inputRowsPerSecond DOUBLE, procRowsPerSecond DOUBLE, "
                "inputRows BIGINT, observed MAP<STRING, BIGINT>, DateValue STRING, event STRING, error STRING, "
                "tags MAP<STRING, STRING>, lateRows BIGINT, stateRows BIGINT, recorded BIGINT")
_NAMES = ["id", "run_id", "name", "batch_id", "sink", "durationms", "inputRowsPerSecond", "procRowsPerSecond",
          "inputRows", "observed", "DateValue", "event", "error", "tags", "lateRows", "stateRows", "recorded"]
_SCALARS = ("id", "name", "batch_id", "sink", "inputRowsPerSecond", "procRowsPerSecond", "inputRows", "DateValue")


def rfc1123_now() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%a, %-d %b %Y %H:%M:%S GMT")


def _num(x):
    try:
        return None if x is None else float(x)
    except (TypeError, ValueError):
        return None


def _as_dict(progress) -> dict:
    """Progress object of a listener event → plain dict of the fields used."""
    def row_dict(r):
        return r.asDict() if hasattr(r, "asDict") else dict(r or {})
    sink = getattr(progress, "sink", None)
    return {
        "id": progress.id, "runId": progress.runId, "name": progress.name, "batchId": progress.batchId,
        "durationMs": dict(progress.durationMs or {}), "numInputRows": progress.numInputRows,
        "inputRowsPerSecond": progress.inputRowsPerSecond,
        "processedRowsPerSecond": progress.processedRowsPerSecond,
        "sink": {"description": getattr(sink, "description", None)},
        "stateOperators": [{"numRowsDroppedByWatermark": op.numRowsDroppedByWatermark, "numRowsTotal": op.numRowsTotal}
                           for op in progress.stateOperators or ()],
        "observedMetrics": {k: row_dict(v) for k, v in (progress.observedMetrics or {}).items()},
    }


def parse_progress(progress) -> dict:
    """One progress object (or its JSON dict) → one metric row."""
    p = progress if isinstance(progress, dict) else _as_dict(progress)
    observed = {}
    for obs_name, row in (p.get("observedMetrics") or {}).items():
        fields = row.asDict() if hasattr(row, "asDict") else (row or {})
        for k, v in fields.items():
            if isinstance(v, (int, float)):
                observed[f"{obs_name.split('_')[0]}.{k}"] = int(v)
    sink = p.get("sink") or {}
    return {
        "id": str(p.get("id")), "run_id": str(p.get("runId")), "name": p.get("name"),
        "batch_id": p.get("batchId"),
        "sink": sink.get("description") if isinstance(sink, dict) else str(sink),
        "durationms": {k: int(v) for k, v in (p.get("durationMs") or {}).items()},
        "inputRowsPerSecond": _num(p.get("inputRowsPerSecond")),
        "procRowsPerSecond": _num(p.get("processedRowsPerSecond")),
        "inputRows": p.get("numInputRows"),
        "observed": observed,
        "lateRows": sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators") or ()),
        "stateRows": sum(op.get("numRowsTotal", 0) for op in p.get("stateOperators") or ()),
        "DateValue": rfc1123_now(),
        "event": "progress", "error": None,
    }


class MetricsListener(StreamingQueryListener):
    """Writes events as rows to ``path``, those of a time slice together, so that rows can be read
    while the job runs, outlive the driver and do not become a file an event. At most a slice's
    rows are in memory. A failure inside the listener becomes an error row and never reaches the query.
    """

    def __init__(self, spark: SparkSession, path: str, context: dict[str, str] | None = None,
                 slice_seconds: float = 5.0):
        """``context``: tags merged into every row's ``tags``; a row's own
        values win over context tags of the same name."""
        super().__init__()
        self._spark = spark
        self.path = path
        self._context = dict(context or {})
        self._slice = slice_seconds
        self._ended: dict[str, threading.Event] = {}
        self._lock, self._writing = threading.Lock(), threading.Lock()
        self._rows: list[tuple] = []
        self._timer: threading.Timer | None = None

    def _append(self, row: dict) -> None:
        own = {k: str(row[k]) for k in _SCALARS if row.get(k) is not None}
        row = {**row, "tags": {**self._context, **own}, "recorded": time.time_ns()}
        with self._lock:
            self._rows.append(tuple(row.get(n) for n in _NAMES))
            if self._timer is None:      # the slice begins with its first row
                self._timer = threading.Timer(self._slice, self.flush)
                self._timer.daemon = True
                self._timer.start()

    def flush(self) -> None:
        """Write the rows of the slice so far."""
        with self._writing:
            with self._lock:
                rows, self._rows = self._rows, []
                if self._timer is not None:
                    self._timer.cancel()
                    self._timer = None
            if not rows:
                return
            try:
                self._spark.createDataFrame(rows, PROGRESS_DDL).coalesce(1).write.mode("append").parquet(self.path)
            except Exception:  # telemetry never stops the job
                logging.getLogger(__name__).exception("%d progress rows not written", len(rows))

    def _end_of(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event):  # start events are ignored
        pass

    def onQueryProgress(self, event):
        try:
            row = parse_progress(event.progress)
        except Exception:
            row = {"event": "listener_error", "error": traceback.format_exc(), "DateValue": rfc1123_now()}
        self._append(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.exception:
            self._append({"id": str(event.id), "run_id": str(event.runId), "event": "terminated",
                          "error": event.exception, "DateValue": rfc1123_now()})
        self._end_of(event.runId).set()

    def drain(self, run_id: str, timeout: float = 60.0) -> bool:
        """Wait until every event of an ended run has been written: its
        termination is the last one the asynchronous bus delivers. False if it has not come in time."""
        ended = self._end_of(run_id).wait(timeout)
        self.flush()
        return ended

    def to_dataframe(self, spark: SparkSession | None = None) -> DataFrame:
        return (spark or self._spark).read.schema(PROGRESS_DDL).parquet(self.path)


def last_of_each_batch(rows: DataFrame) -> DataFrame:
    """Progress rows with one row a (query, batch): a batch that was replayed counts once, as last recorded."""
    progress = rows.filter("event = 'progress'")
    return progress.groupBy("id", "batch_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("id", "batch_id")]), "recorded").alias(
        "r")).select("id", "batch_id", "r.*")
