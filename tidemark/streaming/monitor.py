"""What streaming queries report of themselves: running sums that no length of a query shortens.

`watched` starts a query under a listener. Spark keeps only the last progress reports of a query
(`spark.sql.streaming.numRecentProgressUpdates`); the listener adds up each report as it comes, so the sums hold
over any number of batches, and hands it on, so that each batch becomes a row of the step metrics.
"""

from __future__ import annotations

import threading
import time
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from tidemark.sinks.lake import Lake

VALIDATED = "validated"
STEP_METRIC = (
    "step string, crypto_id string, status string, duration_seconds double, "
    "rows long, valid long, invalid long, dropped long"
)


@dataclass(frozen=True)
class BatchReport:
    """One batch: rows read, rows the watermark dropped, and how long it took."""

    batch_id: int
    rows: int
    dropped: int
    seconds: float
    observed: dict


class Monitor(StreamingQueryListener):
    """Sums by run of a query; reports of batches wait until someone takes them."""

    def __init__(self) -> None:
        self._lock = threading.Condition()
        self._dropped: dict[str, int] = defaultdict(int)
        self._batches: dict[str, int] = defaultdict(int)
        self._waiting: dict[str, list[BatchReport]] = defaultdict(list)
        self._takers: dict[str, Callable[[BatchReport], None] | None] = {}
        self._ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        report = BatchReport(
            p.batchId,
            int(p.numInputRows),
            sum(int(op.numRowsDroppedByWatermark) for op in p.stateOperators),
            p.batchDuration / 1000.0,
            {name: row.asDict() for name, row in (p.observedMetrics or {}).items()},
        )
        with self._lock:
            self._dropped[run] += report.dropped
            self._batches[run] += 1
            known, taker = run in self._takers, self._takers.get(run)
            if not known:
                self._waiting[run].append(report)
        if taker is not None:
            taker(report)

    def deliver(self, run: str, taker: Callable[[BatchReport], None] | None) -> None:
        """From now on reports of a run go to `taker`, those that came before it included."""
        with self._lock:
            self._takers[run] = taker
            early = self._waiting.pop(run, [])
        for report in early if taker is not None else []:
            taker(report)

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def settle(self, query: StreamingQuery, seconds: float = 30.0) -> None:
        """Wait for the reports of an ended query: they come on another thread."""
        if query.isActive:
            return
        until = time.monotonic() + seconds
        with self._lock:
            while str(query.runId) not in self._ended and time.monotonic() < until:
                self._lock.wait(0.2)

    def dropped(self, query: StreamingQuery) -> int:
        self.settle(query)
        with self._lock:
            return self._dropped[str(query.runId)]

    def batches(self, query: StreamingQuery) -> int:
        self.settle(query)
        with self._lock:
            return self._batches[str(query.runId)]


_MONITORS: dict[int, Monitor] = {}


def monitor(spark: SparkSession) -> Monitor:
    """The listener of a session's streams, added when it is first asked for."""
    key = id(spark.sparkContext)
    if key not in _MONITORS:
        _MONITORS[key] = Monitor()
        spark.streams.addListener(_MONITORS[key])
    return _MONITORS[key]


def watched(writer: DataStreamWriter, taker: Callable[[BatchReport], None] | None = None) -> StreamingQuery:
    """Start the query under the listener; `taker` gets the report of each batch."""
    held = monitor(writer._spark)
    query = writer.start()
    held.deliver(str(query.runId), taker)
    return query


def step_rows(lake: Lake, step: str, run: str) -> Callable[[BatchReport], None]:
    """A taker that stores each report as a row of the step metrics, under its run and batch."""

    def store(report: BatchReport) -> None:
        counted = report.observed.get(VALIDATED, {})
        row = (step, "all", "success", report.seconds, report.rows, counted.get("valid"), counted.get("invalid"), report.dropped)
        store_steps(lake, [row], run, report.batch_id)

    return store


def store_steps(lake: Lake, rows: list[tuple], run: str, batch_id: int) -> None:
    """Step metrics of one batch; a repeated batch replaces its rows."""
    now = F.lit(lake.batch_time(run, batch_id))
    steps = lake.spark.createDataFrame(rows, STEP_METRIC)
    lake.write_batch(steps.withColumns({"recorded_at": now, "date": F.to_date(now)}), "step_metrics", batch_id, run)


def counted(checked: DataFrame) -> DataFrame:
    """Checked events, whose valid and invalid rows are counted as they pass."""
    return checked.observe(
        VALIDATED, F.count_if("valid").alias("valid"), F.count_if(~F.col("valid")).alias("invalid")
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as too late since the query was started, however long ago."""
    return monitor(SparkSession.active()).dropped(query)
