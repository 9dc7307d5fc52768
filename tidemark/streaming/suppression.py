"""Suppression of repeated alerts on a stream, in Spark's keyed state.

The flag of an alert depends on the alert before it, by event time. So an alert waits in the state until the
watermark has passed it: then no earlier one can come any more, and the flag is that of `suppress_alerts`
over the whole table, whatever the order and the batches in which alerts arrived. Rows behind the
watermark are dropped by Spark and counted by `late_rows`.

The state's key is rule, asset and time bucket. An alert near the end of a bucket is sent to the next one
too, as the one before that bucket's first. So a hot asset is one small state per bucket, no state
outlives its bucket (an event-time timer removes it), and a backlog of many buckets is worked on side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.session import apply_settings, shared_dir, ship_with_jobs
from tidemark.sinks.lake import Lake
from tidemark.streaming.monitor import watched

KEY = ["rule_id", "crypto_id"]
BUCKET_MINUTES = 60
STATE = "last long, waiting binary"
NEVER = -(1 << 62)
_AT, _BUCKET, _BEFORE = "_at", "_bucket", "_before"


def _packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _judge(minutes: int, bucket_minutes: int, columns: list[str]):
    """The state function of one rule, asset and bucket."""
    gap, bucket_us = minutes * 60_000_000, bucket_minutes * 60_000_000

    def run(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        last, waiting = state.get if state.exists else (NEVER, None)
        parts = [_unpacked(bytes(waiting))] if waiting else []
        if not state.hasTimedOut:
            parts += [c for c in chunks if len(c)]
        if pd.isna(key[-1]):
            yield from (part[columns].assign(suppressed=False) for part in parts)
            return
        rows = pd.concat(parts) if parts else pd.DataFrame({_AT: [], _BEFORE: []})
        rows = rows.sort_values(_AT, kind="stable")
        settled = rows[_AT] <= watermark * 1000
        ready, rest = rows[settled], rows[~settled]
        if len(ready):
            before = ready[_AT].shift(fill_value=last)
            flagged = ready.assign(suppressed=(ready[_AT] - before < gap).to_numpy())
            last = int(ready[_AT].iloc[-1])
            own = flagged[~flagged[_BEFORE].astype(bool)]
            if len(own):
                yield own[[*columns, "suppressed"]]
        bucket_end = (int(key[-1]) + 1) * bucket_us // 1000
        if not len(rest) and watermark >= bucket_end:
            if state.exists:
                state.remove()
            return
        state.update((last, _packed(rest) if len(rest) else None))
        # A timer fires once the watermark is beyond it.
        due = -(-int(rest[_AT].iloc[0]) // 1000) - 1 if len(rest) else bucket_end
        state.setTimeoutTimestamp(max(due, watermark + 1))

    return run


def suppress_stream(
    alerts: DataFrame, minutes: int = 30, delay: str = "10 minutes", bucket_minutes: int = BUCKET_MINUTES
) -> DataFrame:
    """Alerts of a stream with their flag `suppressed`, each once, when the watermark passes it.

    Alerts without a time have no place in the order: they pass at once, and nothing suppresses them.
    """
    if bucket_minutes < minutes:
        raise ValueError("a bucket must be at least as long as the time of suppression")
    bucket_us = bucket_minutes * 60_000_000
    columns = alerts.columns
    at = F.unix_micros(F.col("triggered_at").cast("timestamp"))
    bucket = F.floor(F.col(_AT) / bucket_us).cast("long")
    # The buckets an alert is known to: its own, and the next one if that begins within the time of suppression.
    known_to = F.filter(
        F.array(
            F.struct(bucket.alias(_BUCKET), F.lit(False).alias(_BEFORE)),
            F.struct((bucket + 1).alias(_BUCKET), F.lit(True).alias(_BEFORE)),
        ),
        lambda b: ~b[_BEFORE] | (b[_BUCKET] * bucket_us - F.col(_AT) < minutes * 60_000_000),
    )
    placed = (
        alerts.withWatermark("triggered_at", delay)
        .withColumn(_AT, at)
        .select(*columns, _AT, F.inline(known_to))
    )
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in alerts.schema)
    return placed.groupBy(*KEY, _BUCKET).applyInPandasWithState(
        _judge(minutes, bucket_minutes, columns),
        f"{fields}, suppressed boolean",
        STATE,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )


def start_suppression(
    alerts: DataFrame,
    lake: Lake,
    checkpoint: str,
    minutes: int = 30,
    trigger: dict | None = None,
    delay: str = "10 minutes",
    bucket_minutes: int = BUCKET_MINUTES,
) -> StreamingQuery:
    """Alerts of a stream with their flag, appended to the alert history.

    State and progress are Spark's, in the checkpoint; a repeated batch replaces its own output.
    """
    apply_settings(lake.spark)
    shared_dir(lake.spark)
    run = lake.run_of(checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        lake.write_batch(batch.withColumn("date", F.to_date("triggered_at")), "alert_history", batch_id, run)

    return watched(
        suppress_stream(alerts, minutes, delay, bucket_minutes)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )


ship_with_jobs(__name__)
