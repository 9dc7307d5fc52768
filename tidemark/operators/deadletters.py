"""Dead letters: records, scans, replay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import clean_number, count_where, parsed_time
from tidemark.operators.validation import validate_aggregates, validate_events
from tidemark.schema import AGGREGATE_EVENT, PRICE_EVENT, TRACKED_IDS
from tidemark.sources.landed import parsed_once, where_equal


def dead_letters(
    failed: DataFrame, step: str | Column, failed_at: Column, event: str = "raw", error: Column | None = None
) -> DataFrame:
    """Failed rows as dead letters; keeps the event text, so that it can be replayed."""
    text = error if error is not None else F.concat(F.lit("["), F.array_join("errors", ", "), F.lit("]"))
    return failed.select(
        F.col(event).alias("event"),
        text.alias("error"),
        (F.lit(step) if isinstance(step, str) else step).alias("step"),
        failed_at.alias("failed_at"),
        F.coalesce("crypto_id", F.lit("unknown")).alias("crypto_id"),
        F.to_date(failed_at).alias("date"),
    )


def dlq_scan(letters: DataFrame, date: str, step: str | None = None) -> DataFrame:
    return where_equal(letters.filter(F.col("date") == F.lit(date).cast("date")), step=step)


def replay(
    letters: DataFrame, tracked: Sequence[str] = TRACKED_IDS, threshold: float = 10.0
) -> DataFrame:
    """Run every letter through its step again; adds `outcome` and `replayed`.

    validate: the event passes now. postgres: key and time are present. s3: there is an event.
    alert: an alert is due, or none is due any more; a missing change still fails. The two stream
    steps hold aggregates and are checked as such. Any other step fails.
    """
    both = StructType([*PRICE_EVENT, *[f for f in AGGREGATE_EVENT if f.name != "crypto_id"]])
    parsed = letters.withColumnRenamed("crypto_id", "_letter_id").select(
        "*", parsed_once(F.col("event"), both)
    )
    events = validate_events(parsed, tracked).withColumn("_event_valid", F.col("valid"))
    checked = validate_aggregates(
        events.withColumns({c: parsed_time(c) for c in ("window_start", "window_end")})
    )
    step, change = F.col("step"), clean_number("change_24h_pct")
    storable = F.col("crypto_id").isNotNull() & F.col("timestamp_format")

    def passes(condition: Column, name: str) -> Column:
        return F.when(condition, name).otherwise("failed")

    outcome = (
        F.when(step == "validate", passes(F.col("_event_valid"), "valid"))
        .when(step == "postgres", passes(storable, "stored"))
        .when(step == "s3", passes(F.col("event").isNotNull(), "stored"))
        .when(
            step == "alert",
            F.when(change > threshold, "PUMP")
            .when(change < -threshold, "DUMP")
            .otherwise(passes(change.isNotNull(), "no_alert")),
        )
        .when(step.isin("spark_postgres", "spark_s3"), passes(F.col("valid"), "valid"))
        .otherwise("failed")
    )
    kept = [F.col("_letter_id" if c == "crypto_id" else c).alias(c) for c in letters.columns]
    return checked.select(*kept, outcome.alias("outcome")).withColumn(
        "replayed", F.col("outcome") != "failed"
    )


def replay_summary(replayed: DataFrame, *by: str) -> DataFrame:
    total, done = F.count(F.lit(1)), count_where(F.col("replayed"))
    return replayed.groupBy(*by).agg(
        total.alias("total"), done.alias("replayed"), (total - done).alias("still_failing")
    )
