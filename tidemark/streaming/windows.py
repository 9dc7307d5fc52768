"""Streaming window aggregates, with a watermark or with mergeable partial aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import without_nan
from tidemark.operators.deadletters import dead_letters
from tidemark.operators.dedup import new_rows
from tidemark.operators.marts import NUMBERS, session_agg, window_agg
from tidemark.operators.validation import split, validate_aggregates, validate_events
from tidemark.schema import TRACKED_IDS
from tidemark.session import apply_settings, pin, shared_dir
from tidemark.sinks.lake import Lake
from tidemark.sources.landed import arrival, parse_events, with_event_time
from tidemark.streaming.monitor import counted, late_rows, step_rows, watched

__all__ = [
    "aggregate_stream", "late_rows", "merge_batch", "merged_windows", "partial_windows", "start_aggregation", "start_merging", "start_sessions",
    "store_aggregates", "valid_stream",
]

EVENT_KEY = ["crypto_id", "event_timestamp"]


def valid_stream(raw: DataFrame, delay: str, tracked: Sequence[str] = TRACKED_IDS) -> DataFrame:
    """Valid events, each key once, with a watermark `delay` behind the newest event."""
    valid, _ = split(counted(validate_events(with_event_time(parse_events(raw)), tracked)))
    return (
        valid.drop("raw", "errors")
        .withWatermark("event_timestamp", delay)
        .dropDuplicatesWithinWatermark(["crypto_id", "event_timestamp"])
    )


def aggregate_stream(
    raw: DataFrame,
    delay: str = "10 minutes",
    size: str = "1 minute",
    slide: str | None = None,
    tracked: Sequence[str] = TRACKED_IDS,
) -> DataFrame:
    """Window aggregates of a stream. State is bounded by the watermark; later rows are dropped
    and counted by `late_rows`."""
    return window_agg(valid_stream(raw, delay, tracked), size, slide)


def store_aggregates(batch: DataFrame, batch_id: int, lake: Lake, run: str = "manual") -> None:
    """Check a micro-batch of aggregates, quarantine bad ones, merge the others by key."""
    checked = validate_aggregates(batch).persist()
    try:
        valid, invalid = split(checked)
        letters = invalid.withColumn("raw", F.to_json(F.struct(*batch.columns)))
        lake.write_batch(
            dead_letters(letters, "spark_postgres", F.lit(lake.batch_time(run, batch_id))), "dead_letters", batch_id, run
        )
        keyed = valid.select(
            *batch.columns,
            F.to_date("window_start").alias("date"),
            F.hour("window_start").alias("hour"),
        )
        lake.upsert(keyed, "aggregations", ["crypto_id", "window_start"], batch_id, run)
    finally:
        checked.unpersist()


def start_aggregation(
    raw: DataFrame,
    lake: Lake,
    checkpoint: str,
    delay: str = "10 minutes",
    size: str = "1 minute",
    tracked: Sequence[str] = TRACKED_IDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Window aggregates in update mode, merged into the aggregate table."""
    shared_dir(lake.spark)
    run = lake.run_of(checkpoint)
    writer = (
        aggregate_stream(raw, delay, size, tracked=tracked)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: store_aggregates(batch, batch_id, lake, run))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    return watched(writer, step_rows(lake, "spark_process", run))


def start_sessions(
    raw: DataFrame,
    lake: Lake,
    checkpoint: str,
    gap: str = "30 minutes",
    delay: str = "10 minutes",
    tracked: Sequence[str] = TRACKED_IDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Session aggregates, each stored once when the watermark has passed its end."""
    apply_settings(lake.spark)
    shared_dir(lake.spark)
    run = lake.run_of(checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        lake.write_batch(batch.withColumn("date", F.to_date("session_start")), "sessions", batch_id, run)

    writer = (
        session_agg(valid_stream(raw, delay, tracked), gap)
        .writeStream.outputMode("append")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    return watched(writer, step_rows(lake, "spark_process", run))


# ---- any lateness: partial aggregates per batch ---------------------------------------
def partial_windows(events: DataFrame, size: str = "1 minute") -> DataFrame:
    """Sums and counts from which window aggregates can be merged in any order."""
    return (
        without_nan(events, *NUMBERS)
        .groupBy("crypto_id", F.window("event_timestamp", size).alias("_w"))
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.sum("price_usd").alias("price_sum"),
            F.count("price_usd").alias("price_count"),
            F.min("price_usd").alias("min_price"),
            F.max("price_usd").alias("max_price"),
            F.sum("change_24h_pct").alias("change_sum"),
            F.count("change_24h_pct").alias("change_count"),
        )
        .select(
            "crypto_id",
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *[
                "record_count", "price_sum", "price_count", "min_price", "max_price",
                "change_sum", "change_count",
            ],
        )
    )


def merged_windows(partials: DataFrame) -> DataFrame:
    """Window aggregates over all partials stored so far."""

    def mean(total: str, count: str):
        n = F.sum(count)
        return F.sum(total) / F.when(n > 0, n)

    low, high = F.min("min_price"), F.max("max_price")
    return partials.groupBy("crypto_id", "window_start", "window_end").agg(
        mean("price_sum", "price_count").alias("avg_price"),
        low.alias("min_price"),
        high.alias("max_price"),
        (high - low).alias("price_range"),
        mean("change_sum", "change_count").alias("avg_change_24h"),
        F.sum("record_count").alias("record_count"),
    )


def merge_batch(
    batch: DataFrame, batch_id: int, lake: Lake, run: str, size: str = "1 minute", tracked: Sequence[str] = TRACKED_IDS
) -> None:
    """The partials of the events of one batch that no earlier batch had."""
    checked = validate_events(with_event_time(parse_events(batch)), tracked)
    valid, _ = split(checked)
    dated = valid.withColumns({"date": F.to_date("event_timestamp"), "_arrival": arrival(valid)}).drop("raw", "errors")
    dated = dated.persist()
    try:
        known = lake.matching(dated, "event_keys", EVENT_KEY, run, batch_id)
        fresh = pin(new_rows(dated, known, EVENT_KEY, "_arrival").drop("_arrival"))
    finally:
        dated.unpersist()
    windows = partial_windows(fresh, size)
    placed = windows.withColumns({"date": F.to_date("window_start"), "hour": F.hour("window_start")})
    lake.write_batch(placed, "partials", batch_id, run)
    lake.write_batch(fresh.select(*EVENT_KEY, "date"), "event_keys", batch_id, run)


def start_merging(
    raw: DataFrame,
    lake: Lake,
    checkpoint: str,
    size: str = "1 minute",
    tracked: Sequence[str] = TRACKED_IDS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Stateless form: each batch stores partials in its own folder, whatever their event time.

    Each event counts once, in whichever batch it comes first: the keys of counted events are kept by day, and a batch
    looks its own up in the days it touches. A batch that runs twice replaces what it wrote and doesn't find its
    own keys. One query writes a lake's partials. Readers use `merged_windows`.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, lake, run, size, tracked)

    shared_dir(lake.spark)
    run = lake.run_of(checkpoint)
    writer = (
        raw.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    return watched(writer, step_rows(lake, "spark_process", run))
