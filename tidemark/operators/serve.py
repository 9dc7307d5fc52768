"""Serving queries over the stored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import at_time
from tidemark.operators.marts import window_agg
from tidemark.sources.landed import since

_AGGS = ["crypto_id", "window_start", "window_end", "avg_price", "min_price", "max_price"]


def latest_prices(prices: DataFrame) -> DataFrame:
    """Newest row of every asset: a hash aggregate on fixed-width values, no sort."""
    return prices.groupBy("crypto_id").agg(
        F.max_by("price_usd", "event_timestamp").alias("price_usd"),
        F.max_by("change_24h_pct", "event_timestamp").alias("change_24h_pct"),
        F.max("event_timestamp").alias("event_timestamp"),
    )


def last_n_prices(prices: DataFrame, n: int = 200) -> DataFrame:
    """The last n prices of every asset, oldest first; each task passes on n rows per asset."""
    newest = Window.partitionBy("crypto_id").orderBy(F.desc("event_timestamp"))
    return (
        prices.select("crypto_id", "event_timestamp", "price_usd")
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
        .orderBy("crypto_id", "event_timestamp")
    )


def prices_recent(prices: DataFrame, crypto_id: str, as_of, hours: float = 24) -> DataFrame:
    return (
        since(prices, "event_timestamp", as_of, hours)
        .filter(F.col("crypto_id") == crypto_id)
        .select("crypto_id", "price_usd", "market_cap_usd", "change_24h_pct", "event_timestamp", "source")
        .orderBy(F.desc("event_timestamp"))
    )


def alerts_recent(alerts: DataFrame, crypto_id: str, as_of, hours: float = 24) -> DataFrame:
    return (
        since(alerts, "created_at", as_of, hours)
        .filter(F.col("crypto_id") == crypto_id)
        .select("crypto_id", "alert_type", "message", "price_usd", "created_at")
        .orderBy(F.desc("created_at"))
    )


def aggs_recent(aggregates: DataFrame, crypto_id: str, as_of, hours: float = 1) -> DataFrame:
    return (
        since(aggregates, "window_start", as_of, hours)
        .filter(F.col("crypto_id") == crypto_id)
        .select(*_AGGS, "record_count")
        .orderBy(F.desc("window_start"))
    )


def windows_since(prices: DataFrame, size: str, as_of, hours: float) -> DataFrame:
    """Aggregates of the windows that start in the last `hours`, from the events of those only."""
    start = at_time(as_of, prices, "event_timestamp") - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    fresh = prices.filter(F.col("event_timestamp") >= start)
    return window_agg(fresh, size).filter(F.col("window_start") >= start)


def dash_prices(prices: DataFrame, as_of, hours: float = 24) -> DataFrame:
    return (
        since(prices, "event_timestamp", as_of, hours)
        .select("crypto_id", "price_usd", "change_24h_pct", "event_timestamp")
        .orderBy(F.desc("event_timestamp"), "crypto_id")
    )


def dash_alerts(alerts: DataFrame, as_of, hours: float = 24, top: int = 50) -> DataFrame:
    return (
        since(alerts, "created_at", as_of, hours)
        .select("alert_type", "crypto_id", "message", "created_at")
        .orderBy(F.desc("created_at"), "crypto_id")
        .limit(top)
    )


def dash_aggs(aggregates: DataFrame, as_of, hours: float = 1, top: int = 50) -> DataFrame:
    return (
        since(aggregates, "window_start", as_of, hours)
        .select(*_AGGS, "price_range", "record_count")
        .orderBy(F.desc("window_start"), "crypto_id")
        .limit(top)
    )


def price_history(prices: DataFrame, crypto_id: str) -> DataFrame:
    return (
        prices.filter(F.col("crypto_id") == crypto_id)
        .select("event_timestamp", "price_usd")
        .orderBy("event_timestamp")
    )


def price_comparison(prices: DataFrame, assets: DataFrame, selected: Sequence[str]) -> DataFrame:
    """Latest price of the selected assets that have one."""
    chosen = F.col("crypto_id").isin(list(selected))
    dimension = F.broadcast(assets.filter(chosen))
    return latest_prices(prices.filter(chosen)).join(dimension, "crypto_id").select("symbol", "price_usd")


def asset_summary(
    assets: DataFrame, prices: DataFrame, alerts: DataFrame, aggregates: DataFrame, as_of
) -> DataFrame:
    """Latest price, latest alert of 24 hours and latest window of one hour per asset."""
    price = prices.groupBy("crypto_id").agg(
        F.max_by("price_usd", "event_timestamp").alias("price_usd"),
        F.max("event_timestamp").alias("price_timestamp"),
    )
    alert = since(alerts, "created_at", as_of, 24).groupBy("crypto_id").agg(
        F.max_by("alert_type", "created_at").alias("alert_type"),
        F.max_by("message", "created_at").alias("alert_message"),
        F.max("created_at").alias("alert_created_at"),
    )
    window = since(aggregates, "window_start", as_of, 1).groupBy("crypto_id").agg(
        F.max_by("avg_price", "window_start").alias("avg_price"),
        F.max("window_start").alias("window_start"),
    )
    out = assets.select("crypto_id")
    for side in (price, alert, window):
        out = out.join(side, "crypto_id", "left")
    return out


def dashboard_latest(assets: DataFrame, prices: DataFrame) -> DataFrame:
    """Every asset with its latest price, null when it has none."""
    latest = latest_prices(prices).withColumnRenamed("event_timestamp", "last_updated")
    return assets.select("crypto_id").join(latest, "crypto_id", "left")


def kpi_row(assets: DataFrame, prices: DataFrame) -> DataFrame:
    """Display texts of the latest price and change, N/A without a price."""
    price = F.coalesce("price_usd", F.lit(0.0))
    text = F.when(price >= 1, F.format_string("$%,.2f", price)).otherwise(
        F.format_string("$%.4f", price)
    )
    latest = latest_prices(prices)
    return assets.join(latest, "crypto_id", "left").select(
        "symbol",
        F.when(F.col("event_timestamp").isNull(), "N/A").otherwise(text).alias("price_text"),
        F.when(
            F.col("event_timestamp").isNotNull(),
            F.format_string("%+.2f%%", F.coalesce("change_24h_pct", F.lit(0.0))),
        ).alias("change_text"),
    )
