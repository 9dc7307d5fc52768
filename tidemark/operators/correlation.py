"""Daily price matrix, correlation and beta."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import clean_number


def daily_closes(prices: DataFrame, ids: Sequence[str], as_of, days: int = 30) -> DataFrame:
    """Last price per asset and day of the `days` days up to the day of `as_of`."""
    today = F.to_date(F.lit(str(as_of)))
    day = F.to_date("event_timestamp")
    return (
        prices.filter(F.col("crypto_id").isin(list(ids)))
        .filter((day > F.date_sub(today, days)) & (day <= today))
        .groupBy("crypto_id", day.alias("date"))
        .agg(F.max_by(clean_number("price_usd"), "event_timestamp").alias("close"))
    )


def price_matrix(closes: DataFrame, ids: Sequence[str], as_of, days: int = 30) -> DataFrame:
    """One row per day, one column per asset; a missing price is null."""
    today = F.to_date(F.lit(str(as_of)))
    spine = closes.sparkSession.range(days).select(
        F.date_sub(today, F.col("id").cast("int")).alias("date")
    )
    wide = closes.groupBy("date").pivot("crypto_id", list(ids)).agg(F.first("close"))
    return spine.join(wide, "date", "left").orderBy("date")


def matrix_returns(matrix: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Returns between neighbouring days of the matrix; a gap gives no return."""
    before = matrix.select(
        F.date_add("date", 1).alias("date"), *[F.col(i).alias(f"_{i}") for i in ids]
    )
    return matrix.join(before, "date", "left").select(
        "date", *[_ratio(F.col(i), F.col(f"_{i}")).alias(i) for i in ids]
    )


def _ratio(now: Column, before: Column) -> Column:
    return now / F.when(before != 0, before) - 1


def correlation_pairs(matrix: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair of columns over the days both have; null without such days.

    Days are joined to themselves, so the plan does not grow with the number of ids and the work is
    pairs times days.
    """
    closes = matrix.unpivot("date", list(ids), "crypto1", "v1").withColumn("v1", clean_number("v1"))
    others = closes.toDF("date", "crypto2", "v2")
    return (
        closes.join(others, "date")
        .filter("crypto1 < crypto2")
        .groupBy("crypto1", "crypto2")
        .agg(F.corr("v1", "v2").alias("_r"))
        .select("crypto1", "crypto2", clean_number("_r").alias("correlation"))
    )


def high_correlation(pairs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs above the threshold; compared before rounding, and negative ones never qualify."""
    return pairs.filter(F.col("correlation") > threshold).withColumn(
        "correlation", F.round("correlation", 4)
    )


def correlation_extremes(pairs: DataFrame) -> DataFrame:
    pair = F.concat_ws("/", "crypto1", "crypto2")
    known = pairs.filter("correlation is not null").withColumn("_pair", pair)
    order = F.struct("correlation", "_pair")
    return known.agg(
        F.min_by("_pair", order).alias("lowest_pair"),
        F.min("correlation").alias("lowest"),
        F.max_by("_pair", order).alias("highest_pair"),
        F.max("correlation").alias("highest"),
    )


def daily_returns(closes: DataFrame) -> DataFrame:
    """Change to the day before per asset; a gap gives no return. One row per asset and day."""
    w = Window.partitionBy("crypto_id").orderBy("date")
    neighbour = F.datediff("date", F.lag("date").over(w)) == 1
    change = _ratio(F.col("close"), F.lag("close").over(w))
    return closes.withColumn("daily_return", F.when(neighbour, change)).filter(
        "daily_return is not null"
    )


def beta(closes: DataFrame, ids: Sequence[str], proxy: str) -> DataFrame:
    """Beta of every asset but the proxy against the proxy's daily returns, 0 where undefined."""
    returns = daily_returns(closes)
    market = returns.filter(F.col("crypto_id") == proxy).select(
        "date", F.col("daily_return").alias("market")
    )
    fitted = (
        returns.filter(F.col("crypto_id") != proxy)
        .join(market, "date")
        .groupBy("crypto_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.covar_samp("daily_return", "market").alias("_cov"),
            F.var_samp("market").alias("_var"),
        )
    )
    wanted = closes.sparkSession.createDataFrame(
        [(i,) for i in ids if i != proxy], "crypto_id string"
    )
    value = F.when((F.col("_n") >= 2) & (F.col("_var") != 0), F.col("_cov") / F.col("_var"))
    return wanted.join(fitted, "crypto_id", "left").select(
        "crypto_id", F.round(F.coalesce(value, F.lit(0.0)), 4).alias("beta")
    )
