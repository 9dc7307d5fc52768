"""Freshness, completeness, anomalies, and the health report over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import at_time, clean_number, count_where, epoch_seconds, lookup_join, sized
from tidemark.schema import EXPECTED_DATASETS, GRADE_FLOORS
from tidemark.session import pin


def freshness(assets: DataFrame, prices: DataFrame, as_of) -> DataFrame:
    """Hours since the latest event of every asset; 999 and not fresh without one."""
    latest = prices.groupBy("crypto_id").agg(F.max("event_timestamp").alias("_last"))
    now = at_time(as_of, prices, "event_timestamp")
    hours = (epoch_seconds(now) - epoch_seconds("_last")) / 3600
    return assets.select("crypto_id").join(latest, "crypto_id", "left").select(
        "crypto_id",
        F.coalesce(F.round(hours, 3), F.lit(999.0)).alias("hours_since_update"),
        F.coalesce(hours < 2, F.lit(False)).alias("is_fresh"),
    )


def partitions_of(rows: DataFrame, time: str, dataset: str) -> DataFrame:
    """The (asset, day) partitions a dataset has."""
    return (
        rows.groupBy("crypto_id", F.to_date(time).alias("date"))
        .agg(F.lit(dataset).alias("dataset"))
    )


def completeness(
    assets: DataFrame,
    present: DataFrame,
    first: str,
    last: str,
    expected: Sequence[str] = tuple(EXPECTED_DATASETS),
) -> DataFrame:
    """Share of the expected datasets per asset and day, with the missing ones.

    `present` holds (crypto_id, date, dataset) of the partitions that exist. Presence of a dataset
    is one flag of an aggregate, so no asset-by-day-by-dataset frame is joined.
    """
    flags = present.groupBy("crypto_id", "date").agg(
        *[F.max(F.col("dataset") == d).alias(f"_{d}") for d in expected]
    )
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    spine = assets.select("crypto_id", F.explode(days).alias("date"))
    lacking = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.col(f"_{d}"), F.lit(False)), F.lit(d)) for d in expected])
    )
    total = len(expected)
    return spine.join(flags, ["crypto_id", "date"], "left").withColumn("missing", lacking).select(
        "crypto_id",
        "date",
        F.round((F.lit(total) - F.size("missing")) / F.lit(float(total)) * 100, 1).alias("completeness_pct"),
        "missing",
    )


def price_anomalies(prices: DataFrame, sigmas: float = 3.0, minimum: int = 3) -> DataFrame:
    """Prices more than `sigmas` population deviations from the asset's mean."""
    usable = prices.select("crypto_id", clean_number("price_usd").alias("_p")).filter("_p is not null")
    stats = usable.groupBy("crypto_id").agg(
        F.count(F.lit(1)).alias("_n"), F.avg("_p").alias("_mean"), F.stddev_pop("_p").alias("_std")
    )
    far = (F.col("_n") >= minimum) & (F.col("_std") > 0) & (
        F.abs(F.col("_p") - F.col("_mean")) > sigmas * F.col("_std")
    )
    counted = lookup_join(usable, stats, ["crypto_id"]).groupBy("crypto_id").agg(
        count_where(far).alias("anomaly_count"), F.count(F.lit(1)).alias("_total")
    )
    return counted.select(
        "crypto_id",
        "anomaly_count",
        F.round(F.col("anomaly_count") / F.col("_total") * 100, 2).alias("anomaly_pct"),
    )


def price_checks(
    assets: DataFrame, prices: DataFrame, as_of, sigmas: float = 3.0, minimum: int = 3
) -> DataFrame:
    """Freshness and anomalies of every asset side by side: one aggregate over the prices, and one count.

    The newest time, number, mean and deviation come from one pass; a second one counts the prices
    that are far from the mean.
    """
    rows = prices.select("crypto_id", "event_timestamp", clean_number("price_usd").alias("_p"))
    stats = pin(
        rows.groupBy("crypto_id").agg(
            F.max("event_timestamp").alias("_last"),
            F.count("_p").alias("_n"),
            F.avg("_p").alias("_mean"),
            F.stddev_pop("_p").alias("_std"),
        )
    )
    hours = (epoch_seconds(at_time(as_of, prices, "event_timestamp")) - epoch_seconds("_last")) / 3600
    reach = F.when((F.col("_n") >= minimum) & (F.col("_std") > 0), sigmas * F.col("_std"))
    bounds = stats.filter(reach.isNotNull()).select("crypto_id", "_mean", reach.alias("_reach"))
    far = F.abs(F.col("_p") - F.col("_mean")) > F.col("_reach")
    odd = (
        rows.join(sized(bounds), "crypto_id").groupBy("crypto_id").agg(count_where(far).alias("anomaly_count"))
    )
    share = F.round(F.col("anomaly_count") / F.when(F.col("_n") > 0, F.col("_n")) * 100, 2)
    return (
        assets.select("crypto_id")
        .join(stats, "crypto_id", "left")
        .join(odd, "crypto_id", "left")
        .select(
            "crypto_id",
            F.coalesce(F.round(hours, 3), F.lit(999.0)).alias("hours_since_update"),
            F.coalesce(hours < 2, F.lit(False)).alias("is_fresh"),
            F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
            F.coalesce(share, F.lit(0.0)).alias("anomaly_pct"),
        )
    )


def observatory_score() -> Column:
    fresh = F.when(F.col("is_fresh"), 40.0).otherwise(0.0)
    whole = F.coalesce(F.col("completeness_pct"), F.lit(0.0)) / 100 * 40
    calm = F.when(F.coalesce(F.col("anomaly_pct"), F.lit(100.0)) < 5, 20.0).otherwise(10.0)
    return F.round(fresh + whole + calm, 2)


def observatory(
    fresh: DataFrame, complete: DataFrame, anomalies: DataFrame | None, date: str
) -> DataFrame:
    """The three checks side by side with the score of every asset on `date`.

    Without `anomalies` they are columns of `fresh`, as `price_checks` gives them.
    """
    that_day = complete.filter(F.col("date") == F.lit(date).cast("date")).drop("date")
    joined = fresh.join(that_day, "crypto_id", "left")
    if anomalies is not None:
        joined = joined.join(anomalies, "crypto_id", "left")
    filled = joined.withColumns(
        {
            "anomaly_count": F.coalesce("anomaly_count", F.lit(0)),
            "anomaly_pct": F.coalesce("anomaly_pct", F.lit(0.0)),
        }
    )
    return filled.withColumn("score", observatory_score())


def grade(score: Column) -> Column:
    out = F.lit("F")
    for floor, letter in reversed(GRADE_FLOORS):
        out = F.when(score >= floor, letter).otherwise(out)
    return out


def status(score: Column) -> Column:
    return F.when(score >= 75, "HEALTHY").when(score >= 50, "DEGRADED").otherwise("CRITICAL")


def health_report(observed: DataFrame) -> DataFrame:
    """Score, grade and status of every asset and, in the row `OVERALL`, of their mean score."""
    scores = observed.rollup("crypto_id").agg(
        F.round(F.coalesce(F.avg("score"), F.lit(0.0)), 2).alias("score")
    )
    rows = scores.withColumn("crypto_id", F.coalesce("crypto_id", F.lit("OVERALL")))
    return rows.withColumns({"grade": grade(F.col("score")), "status": status(F.col("score"))})


def health_recommendations(observed: DataFrame) -> DataFrame:
    """One line per problem, or a single line when there is none."""
    old = F.format_string("%s: data is %.1fh old — check ingestion pipeline", "crypto_id", "hours_since_update")
    gaps = F.format_string("%s: %d S3 paths missing — check data pipeline", "crypto_id", F.size("missing"))
    odd = F.format_string("%s: %.1f%% price anomalies — validate source data", "crypto_id", "anomaly_pct")
    lines = F.array_compact(
        F.array(
            F.when(~F.col("is_fresh"), old),
            F.when(F.coalesce(F.col("completeness_pct"), F.lit(100.0)) < 80, gaps),
            F.when(F.col("anomaly_pct") >= 5, odd),
        )
    )
    # At most three rows per asset; pinned, as the second part below looks at it again.
    problems = pin(observed.select("crypto_id", F.explode(lines).alias("recommendation")))
    healthy = (
        problems.agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n = 0")
        .select(
            F.lit(None).cast("string").alias("crypto_id"),
            F.lit("All systems healthy — no action required").alias("recommendation"),
        )
    )
    return problems.unionByName(healthy)
