"""Window aggregates, staging and daily marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import count_where, without_nan
from tidemark.operators.series import ROWS_PER_SEGMENT, rolling, segmented

NUMBERS = ("price_usd", "change_24h_pct")


def window_agg(
    prices: DataFrame, size: str = "1 minute", slide: str | None = None, time: str = "event_timestamp"
) -> DataFrame:
    """Price aggregates per asset and time window, bounds as plain columns; batch or stream."""
    low, high = F.min("price_usd"), F.max("price_usd")
    return (
        without_nan(prices, *NUMBERS)
        .groupBy("crypto_id", F.window(time, size, slide).alias("_w"))
        .agg(
            F.avg("price_usd").alias("avg_price"),
            low.alias("min_price"),
            high.alias("max_price"),
            (high - low).alias("price_range"),
            F.avg("change_24h_pct").alias("avg_change_24h"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .select(
            "crypto_id",
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "avg_price",
            "min_price",
            "max_price",
            "price_range",
            "avg_change_24h",
            "record_count",
        )
    )


def session_agg(prices: DataFrame, gap: str = "30 minutes", time: str = "event_timestamp") -> DataFrame:
    """Price aggregates per asset and session: events of which each is at most `gap` after the one before.

    A session ends `gap` after its last event. On a stream, Spark's own session state merges them, and those the watermark has
    passed come out. On a table, events are first summed up in slots as long as the gap: those of one slot are
    always in one session. So a hot asset is combined before the shuffle, and what is put in order for an asset is at
    most one row per slot, whatever its number of events. Events without a time belong to no session.
    """
    rows = without_nan(prices, *NUMBERS).filter(F.col(time).isNotNull())
    sums = [
        F.sum("price_usd").alias("price_sum"), F.count("price_usd").alias("price_count"),
        F.min("price_usd").alias("min_price"), F.max("price_usd").alias("max_price"),
        F.sum("change_24h_pct").alias("change_sum"), F.count("change_24h_pct").alias("change_count"),
        F.count(F.lit(1)).alias("record_count"),
    ]
    if prices.isStreaming:
        grouped = rows.groupBy("crypto_id", F.session_window(time, gap).alias("_w")).agg(*sums)
        sessions = grouped.select(
            "*", F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end")
        )
    else:
        length = F.expr(f"INTERVAL {gap}")
        slots = rows.groupBy("crypto_id", F.window(time, gap).alias("_w")).agg(
            *sums, F.min(time).alias("_first"), F.max(time).alias("_last")
        )
        by_time = Window.partitionBy("crypto_id").orderBy("_first")
        begins = F.coalesce(F.col("_first") > F.lag("_last").over(by_time) + length, F.lit(True))
        islands = slots.withColumn("_begins", begins).withColumn("_island", F.count_if("_begins").over(by_time))
        added = ["price_sum", "price_count", "change_sum", "change_count", "record_count"]
        sessions = islands.groupBy("crypto_id", "_island").agg(
            *[F.sum(c).alias(c) for c in added],
            F.min("min_price").alias("min_price"), F.max("max_price").alias("max_price"),
            F.min("_first").alias("session_start"), (F.max("_last") + length).alias("session_end"),
        )

    def mean(total: str, count: str) -> Column:
        return F.col(total) / F.when(F.col(count) > 0, F.col(count))

    return sessions.select(
        "crypto_id", "session_start", "session_end", mean("price_sum", "price_count").alias("avg_price"),
        "min_price", "max_price", mean("change_sum", "change_count").alias("avg_change_24h"), "record_count",
    )


def window_ohlc(prices: DataFrame, size: str = "1 minute", time: str = "event_timestamp") -> DataFrame:
    """Open, high, low and close per asset and window."""
    return (
        without_nan(prices, *NUMBERS)
        .groupBy("crypto_id", F.window(time, size).alias("_w"))
        .agg(
            F.min_by("price_usd", time).alias("open"),
            F.max("price_usd").alias("high"),
            F.min("price_usd").alias("low"),
            F.max_by("price_usd", time).alias("close"),
            F.count(F.lit(1)).alias("record_count"),
        )
        .select(
            "crypto_id",
            F.col("_w.start").alias("window_start"),
            "open",
            "high",
            "low",
            "close",
            "record_count",
        )
    )


def stg_prices(prices: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """Staged prices with the change to the asset's previous price."""
    series = segmented(prices, ["crypto_id"], "event_timestamp", rows_per_segment)
    change = F.col("price_usd") - F.col("_previous")
    return (
        rolling(series, 1, {"_previous": lambda w: F.lag("price_usd").over(w)})
        .withColumns({"price_change_usd": change, "is_price_increase": change > 0})
        .drop("_previous")
    )


def stg_alerts(alerts: DataFrame) -> DataFrame:
    severity = F.when(F.col("alert_type").isin("PUMP", "DUMP"), "HIGH").otherwise("MEDIUM")
    return alerts.select(
        "crypto_id", "alert_type", "message", "price_usd", "created_at", severity.alias("severity")
    )


def fct_daily(prices: DataFrame) -> DataFrame:
    low, high = F.min("price_usd"), F.max("price_usd")
    prices = without_nan(prices, *NUMBERS)
    return prices.groupBy("crypto_id", F.to_date("event_timestamp").alias("trade_date")).agg(
        F.avg("price_usd").cast("double").alias("avg_price"),
        low.alias("min_price"),
        high.alias("max_price"),
        (high - low).alias("price_volatility"),
        F.count(F.lit(1)).alias("event_count"),
        F.avg("change_24h_pct").cast("double").alias("avg_change_24h"),
    )


def fct_alerts(alerts: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return alerts.groupBy("crypto_id", F.to_date("created_at").alias("alert_date")).agg(
        total.alias("total_alerts"),
        count_where(F.col("alert_type") == "PUMP").alias("pump_count"),
        count_where(F.col("alert_type") == "DUMP").alias("dump_count"),
        (total / F.lit(24.0)).cast("double").alias("alert_rate"),
    )


def _mart_sides(prices: DataFrame, alerts: DataFrame) -> DataFrame:
    """Per asset and day: price aggregates and the number of alerts, each side grouped alone."""
    keys = ["crypto_id", "trade_date"]
    prices = without_nan(prices, *NUMBERS)
    daily = prices.groupBy("crypto_id", F.to_date("event_timestamp").alias("trade_date")).agg(
        F.avg("price_usd").cast("double").alias("avg_price"),
        F.min("price_usd").alias("min_price"),
        F.max("price_usd").alias("max_price"),
        F.count(F.lit(1)).alias("_prices"),
    )
    raised = alerts.groupBy("crypto_id", F.to_date("created_at").alias("trade_date")).agg(
        F.count(F.lit(1)).alias("_alerts")
    )
    return daily.join(raised, keys, "left").withColumn("_alerts", F.coalesce("_alerts", F.lit(0)))


_MART = ["crypto_id", "trade_date", "avg_price", "min_price", "max_price"]


def daily_mart(prices: DataFrame, alerts: DataFrame) -> DataFrame:
    """Daily summary with the counts of a price-by-alert join on asset and day.

    That join multiplies n prices by m alerts: volume n * max(m, 1), alerts n * m. The products
    come from the two counts, no pair is ever formed.
    """
    n, m = F.col("_prices"), F.col("_alerts")
    return _mart_sides(prices, alerts).select(
        *_MART, (n * F.greatest(m, F.lit(1))).alias("total_volume"), (n * m).alias("alert_count")
    )


def daily_mart_exact(prices: DataFrame, alerts: DataFrame) -> DataFrame:
    """Daily summary with true counts; the recommended form."""
    return _mart_sides(prices, alerts).select(
        *_MART, F.col("_prices").alias("total_volume"), F.col("_alerts").alias("alert_count")
    )
