"""Streaming ingestion: parse, check, store, alert and quarantine in one query."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.alerts import price_alerts
from tidemark.operators.deadletters import dead_letters
from tidemark.operators.validation import split, validate_events
from tidemark.schema import TRACKED_IDS
from tidemark.session import shared_dir
from tidemark.sinks.lake import Lake, stored_prices
from tidemark.sources.landed import arrival, parse_events, with_event_time
from tidemark.streaming.monitor import step_rows, store_steps, watched

KEY = ["crypto_id", "event_timestamp"]


def ingest_batch(
    batch: DataFrame, batch_id: int, lake: Lake, tracked: Sequence[str], threshold: float,
    run: str = "manual",
) -> None:
    """One micro-batch into the price, raw, alert and dead-letter datasets.

    Everything written carries the batch id or is keyed, so a batch that runs twice leaves one
    copy; its dates come from the time at which it was first begun. Step metrics are one row per step
    and batch, those of the last try: rows of the step, and for the price table those it already had as dropped.
    """
    now = F.lit(lake.batch_time(run, batch_id))
    checked = validate_events(with_event_time(parse_events(batch)), tracked).persist()
    metrics: list[tuple] = []

    def timed(step: str, work: Callable[[], dict]) -> None:
        begun = time.time()
        status, found = "failure", {}
        try:
            found = work() or {}
            status = "success"
        finally:
            taken = time.time() - begun
            metrics.append((step, "all", status, taken, *(found.get(c) for c in ("rows", "valid", "invalid", "dropped"))))

    try:
        valid, invalid = split(checked)
        fired = price_alerts(valid, threshold).withColumn("date", F.to_date("created_at"))
        counts: dict = {}

        def validate() -> dict:
            lake.write_batch(dead_letters(invalid, "validate", now), "dead_letters", batch_id, run)
            counts.update(
                checked.agg(
                    F.count(F.lit(1)).alias("rows"),
                    F.count_if("valid").alias("valid"),
                    F.count_if(~F.col("valid")).alias("invalid"),
                ).first().asDict()
            )
            return counts

        def store() -> dict:
            arrivals = stored_prices(valid.withColumn("_arrival", arrival(valid)), now, "_arrival")
            added = lake.insert_if_absent(arrivals, "prices", KEY, "_arrival")
            return {"rows": added, "dropped": counts["valid"] - added}

        def keep() -> dict:
            raw = valid.select("raw", "event_timestamp", F.to_date("event_timestamp").alias("date"), "crypto_id")
            lake.write_batch(raw, "raw", batch_id, run)
            return {"rows": counts["valid"]}

        def alert() -> dict:
            lake.write_batch(fired, "alerts", batch_id, run)
            return {"rows": fired.count()}

        for step, work in (("validate", validate), ("postgres", store), ("s3", keep), ("alert", alert)):
            timed(step, work)
    finally:
        checked.unpersist()
        store_steps(lake, metrics, run, batch_id)


def start_ingestion(
    raw: DataFrame,
    lake: Lake,
    checkpoint: str,
    tracked: Sequence[str] = TRACKED_IDS,
    threshold: float = 10.0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start ingestion of a stream with a `value` column; resumes from its checkpoint."""
    shared_dir(lake.spark)
    run = lake.run_of(checkpoint)
    writer = (
        raw.writeStream.foreachBatch(
            lambda batch, batch_id: ingest_batch(batch, batch_id, lake, tracked, threshold, run)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
    )
    return watched(writer, step_rows(lake, "consume", run))


def alert_stream(raw: DataFrame, tracked: Sequence[str] = TRACKED_IDS, threshold: float = 10.0) -> DataFrame:
    """Price alerts as a stream: stateless, nothing is shuffled."""
    valid, _ = split(validate_events(with_event_time(parse_events(raw)), tracked))
    return price_alerts(valid, threshold)
