"""Event and aggregate checks, the valid / invalid split and its summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import count_where, decimal_text, parsed_time, share_pct
from tidemark.schema import TRACKED_IDS

EVENT_CHECKS = [
    "required_fields",
    "price_positive",
    "valid_crypto",
    "timestamp_format",
    "price_range",
    "change_range",
]
AGGREGATE_CHECKS = ["avg_price_positive", "price_order", "record_count_positive", "window_order"]


def _true(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit("None"))


def validate_events(events: DataFrame, tracked: Sequence[str] = TRACKED_IDS) -> DataFrame:
    """Six checks per event, the verdict and the list of error texts.

    NaN fails every price check. A missing price or timestamp fails its checks without a text of
    its own: the missing-field text already names it.
    """
    price, crypto = F.col("price_usd"), F.col("crypto_id")
    stamp, change = F.col("timestamp"), F.col("change_24h_pct")
    number = ~F.isnan(price)
    missing = F.array_compact(
        F.array(
            *[
                F.when(F.col(c).isNull(), F.lit(f"'{c}'"))
                for c in ("crypto_id", "price_usd", "timestamp")
            ]
        )
    )
    checks = {
        "required_fields": crypto.isNotNull() & price.isNotNull() & stamp.isNotNull(),
        "price_positive": _true((price > 0) & number),
        "valid_crypto": _true(crypto.isin(list(tracked))),
        "timestamp_format": parsed_time(stamp).isNotNull(),
        "price_range": _true(price.between(0.0001, 10_000_000) & number),
        "change_range": change.isNull() | (change.between(-99, 1000) & ~F.isnan(change)),
    }
    ok = {name: F.col(name) for name in checks}
    errors = F.array_compact(
        F.array(
            F.when(
                ~ok["required_fields"],
                F.concat(F.lit("Missing required fields: ["), F.array_join(missing, ", "), F.lit("]")),
            ),
            F.when(
                price.isNotNull() & ~ok["price_positive"],
                F.concat(F.lit("price_usd must be positive, got "), decimal_text(price)),
            ),
            F.when(~ok["valid_crypto"], F.concat(F.lit("Unknown crypto_id: "), _text(crypto))),
            F.when(
                stamp.isNotNull() & ~ok["timestamp_format"],
                F.concat(F.lit("Invalid timestamp format: "), stamp),
            ),
            F.when(
                price.isNotNull() & ~ok["price_range"],
                F.concat(F.lit("price_usd "), decimal_text(price), F.lit(" out of range [0.0001, 10000000]")),
            ),
            F.when(
                ~ok["change_range"],
                F.concat(F.lit("change_24h_pct "), decimal_text(change), F.lit(" out of range [-99, 1000]")),
            ),
        )
    )
    return _judged(events, checks, errors)


def validate_aggregates(aggregates: DataFrame) -> DataFrame:
    """Four checks per window aggregate; window bounds are compared as times."""
    low, mean, high = F.col("min_price"), F.col("avg_price"), F.col("max_price")
    count, start, end = F.col("record_count"), F.col("window_start"), F.col("window_end")
    complete = low.isNotNull() & mean.isNotNull() & high.isNotNull()
    checks = {
        "avg_price_positive": _true((mean > 0) & ~F.isnan(mean.cast("double"))),
        "price_order": _true((low <= mean) & (mean <= high)),
        "record_count_positive": _true(count > 0),
        "window_order": F.coalesce(start < end, F.lit(True)),
    }

    def show(c: Column) -> Column:
        return _text(decimal_text(c.cast("double")))

    errors = F.array_compact(
        F.array(
            F.when(
                ~F.col("avg_price_positive"),
                F.concat(F.lit("avg_price must be positive, got "), show(mean)),
            ),
            F.when(
                complete & ~F.col("price_order"),
                F.concat(F.lit("Price order invalid: min="), show(low), F.lit(" avg="), show(mean),
                         F.lit(" max="), show(high)),
            ),
            F.when(~complete, F.lit("min_price, avg_price, or max_price is None")),
            F.when(
                ~F.col("record_count_positive"),
                F.concat(F.lit("record_count must be positive, got "), _text(count.cast("string"))),
            ),
            F.when(
                ~F.col("window_order"),
                F.concat(F.lit("window_start "), start.cast("string"), F.lit(" is not before window_end "),
                         end.cast("string")),
            ),
        )
    )
    return _judged(aggregates, checks, errors)


def _judged(df: DataFrame, checks: dict[str, Column], errors: Column) -> DataFrame:
    valid = F.lit(True)
    for name in checks:
        valid = valid & F.col(name)
    return df.withColumns(checks).withColumns({"valid": valid, "errors": errors})


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid rows of a validated frame."""
    return validated.filter("valid"), validated.filter("not valid")


def stream_quality(validated: DataFrame) -> DataFrame:
    """Share of valid events in percent, 0 when there are none, and the warning below 80."""
    score = F.coalesce(F.avg(F.col("valid").cast("double")) * 100.0, F.lit(0.0))
    return validated.agg(
        F.count(F.lit(1)).alias("total"), F.round(score, 6).alias("quality_score")
    ).withColumn(
        "warning",
        F.when(
            (F.col("total") > 0) & (F.col("quality_score") < 80),
            F.format_string("Quality score %.1f%% below 80%% threshold", F.col("quality_score")),
        ),
    )


def validation_summary(validated: DataFrame) -> DataFrame:
    total, valid = F.count(F.lit(1)), count_where(F.col("valid"))
    return validated.agg(
        total.alias("total"),
        valid.alias("valid"),
        (total - valid).alias("invalid"),
        F.round(share_pct(valid, total, 6, 0.0), 6).alias("quality_score"),
        F.coalesce(F.sum(F.size("errors")), F.lit(0)).alias("error_count"),
    )


def validation_errors(validated: DataFrame, *keep: str) -> DataFrame:
    """One row per error text, in place of one list that would grow with the data."""
    failed = validated.filter("not valid")
    return failed.select(*keep, F.explode_outer("errors").alias("error")).filter("error is not null")


def error_counts(validated: DataFrame, checks: Sequence[str] = tuple(EVENT_CHECKS)) -> DataFrame:
    """Failures per check in one pass."""
    counts = validated.agg(*[count_where(~F.col(c)).alias(c) for c in checks])
    return counts.unpivot([], list(checks), "check", "failures")


def not_null_checks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of each column in one pass."""
    counts = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_count").withColumn(
        "passed", F.col("null_count") == 0
    )


def run_summary(validated: DataFrame, threshold: float = 10.0) -> DataFrame:
    """Totals of one ingestion run: events, verdicts, alerts, dead letters, quality."""
    total, valid = F.count(F.lit(1)), count_where(F.col("valid"))
    alerting = F.col("valid") & F.coalesce(F.abs("change_24h_pct") > threshold, F.lit(False))
    return validated.agg(
        total.alias("total_events"),
        valid.alias("valid_events"),
        (total - valid).alias("invalid_events"),
        count_where(alerting).alias("alerts_triggered"),
        (total - valid).alias("dlq_events"),
        share_pct(valid, total, 6, 0.0).alias("quality_score"),
    )
