"""Portfolio value and returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import at_time
from tidemark.operators.serve import latest_prices
from tidemark.schema import TOTAL_INVESTMENT


def price_24h_ago(prices: DataFrame, as_of) -> DataFrame:
    """Latest price of every asset between 25 and 23 hours before `as_of`, both ends included."""
    now, t = at_time(as_of, prices, "event_timestamp"), F.col("event_timestamp")
    window = prices.filter(
        t.between(now - F.expr("INTERVAL 25 HOURS"), now - F.expr("INTERVAL 23 HOURS"))
    )
    return latest_prices(window).select("crypto_id", "price_usd", "event_timestamp")


def portfolio_value(portfolio: DataFrame, current: DataFrame, invested: float = TOTAL_INVESTMENT) -> DataFrame:
    """Invested amount per asset, its weight, the total and the top holding.

    The value is the allocated share of the investment; the current price is carried for display.
    """
    held = portfolio.withColumn("_value", F.col("allocation") * invested)
    top = F.min_by(F.col("crypto_id"), F.struct(-F.col("_value"), F.col("crypto_id")))
    total = held.agg(F.sum("_value")).scalar()
    return held.join(current.select("crypto_id", "price_usd"), "crypto_id", "left").select(
        "crypto_id",
        F.round("_value", 2).alias("value"),
        F.coalesce(F.round(F.col("_value") / F.when(total > 0, total) * 100, 4), F.lit(0.0)).alias("weight_pct"),
        F.col("price_usd").alias("current_price"),
        F.round(total, 2).alias("total_value"),
        held.agg(top).scalar().alias("top_holding"),
    )


def portfolio_market_value(
    portfolio: DataFrame, prices: DataFrame, invested: float = TOTAL_INVESTMENT
) -> DataFrame:
    """Value at the latest price of what the investment bought at the first price."""
    span = prices.groupBy("crypto_id").agg(
        F.min_by("price_usd", "event_timestamp").alias("_first"),
        F.max_by("price_usd", "event_timestamp").alias("_latest"),
    )
    units = F.col("allocation") * invested / F.when(F.col("_first") > 0, F.col("_first"))
    return portfolio.join(span, "crypto_id", "left").select(
        "crypto_id",
        F.round(units, 6).alias("units"),
        F.round(units * F.col("_latest"), 6).alias("market_value"),
    )


def portfolio_returns(portfolio: DataFrame, current: DataFrame, previous: DataFrame) -> DataFrame:
    """Daily return per asset and, in the row `TOTAL`, the return weighted by allocation."""
    now = current.select("crypto_id", F.col("price_usd").alias("_now"))
    before = previous.select("crypto_id", F.col("price_usd").alias("_before"))
    cur, prev = F.coalesce("_now", F.lit(0.0)), F.coalesce("_before", F.lit(0.0))
    pct = (cur - prev) / F.when(prev > 0, prev) * 100
    single = (
        portfolio.join(now, "crypto_id", "left")
        .join(before, "crypto_id", "left")
        .select("crypto_id", "allocation", F.round(F.coalesce(pct, F.lit(0.0)), 4).alias("return_pct"))
    )
    total = single.agg(
        F.lit("TOTAL").alias("crypto_id"),
        F.sum("allocation").alias("allocation"),
        F.round(F.sum(F.col("allocation") * F.col("return_pct")), 4).alias("return_pct"),
    )
    return single.unionByName(total)
