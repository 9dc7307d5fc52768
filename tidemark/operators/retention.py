"""Storage inventory, archival, cost, partition keys and expiring tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import at_time, count_where
from tidemark.schema import COLD_COST_PER_GB, STANDARD_COST_PER_GB
from tidemark.sources.landed import day_path

MB = 1024 * 1024


def _old(objects: DataFrame, as_of, days: int):
    cutoff = at_time(as_of, objects, "last_modified") - F.expr(f"INTERVAL {days} DAYS")
    return F.coalesce(F.col("last_modified") < cutoff, F.lit(False))


def archive_candidates(objects: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Objects last modified more than `days` days ago, with their archive key."""
    return objects.filter(_old(objects, as_of, days)).withColumn(
        "archive_key", F.regexp_replace("key", "^raw/", "archive/")
    )


def cold_manifest(objects: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Objects to move to the cold tier; the move itself is a property of the store."""
    return objects.filter(_old(objects, as_of, days)).select(
        "key", "size", F.lit("COLD").alias("target_class")
    )


def storage_size(objects: DataFrame) -> DataFrame:
    return objects.groupBy("prefix").agg(
        F.round(F.sum("size") / F.lit(float(MB)), 4).alias("total_size_mb"),
        F.count(F.lit(1)).alias("object_count"),
    )


def cost_report(objects: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Totals over the prefixes and what moving the old objects to the cold tier would save."""
    by_prefix = objects.withColumn("_old", _old(objects, as_of, days)).groupBy("prefix").agg(
        F.round(F.sum("size") / F.lit(float(MB)), 4).alias("_mb"),
        F.count(F.lit(1)).alias("_n"),
        count_where(F.col("_old")).alias("_c"),
    )
    totals = by_prefix.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_objects"),
        F.coalesce(F.sum("_mb"), F.lit(0.0)).alias("_mb"),
        F.coalesce(F.sum("_c"), F.lit(0)).alias("archival_candidates"),
    )
    n = F.col("total_objects")
    average = F.coalesce(F.col("_mb") / F.when(n > 0, n), F.lit(0.0))
    gb = F.col("archival_candidates") * average / 1024
    return totals.withColumns(
        {
            "total_size_mb": F.round("_mb", 4),
            "standard_cost": F.round(gb * STANDARD_COST_PER_GB, 6),
            "cold_cost": F.round(gb * COLD_COST_PER_GB, 6),
        }
    ).select(
        "total_objects",
        "total_size_mb",
        "archival_candidates",
        "standard_cost",
        "cold_cost",
        F.round(F.col("standard_cost") - F.col("cold_cost"), 6).alias("savings"),
    )


def daily_counts(prices: DataFrame, alerts: DataFrame, aggregates: DataFrame) -> DataFrame:
    """Stored events, alerts and aggregates per day, each table counted on its own."""

    def per_day(df: DataFrame, time: str, name: str) -> DataFrame:
        return df.groupBy(F.to_date(time).alias("date")).agg(F.count(F.lit(1)).alias(name))

    out = per_day(prices, "event_timestamp", "total_events")
    out = out.join(per_day(alerts, "created_at", "total_alerts"), "date", "full")
    out = out.join(per_day(aggregates, "window_start", "total_aggregations"), "date", "full")
    return out.select(
        "date",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total_events", "total_alerts", "total_aggregations")],
    )


def with_raw_keys(events: DataFrame, as_of) -> DataFrame:
    """Partition keys of raw events: day of the event text, `as_of` and `unknown` as fallbacks."""
    stamp = F.coalesce(F.col("timestamp"), F.lit(str(as_of)))
    return events.withColumns(
        {
            "date_path": F.replace(F.substring(stamp, 1, 10), F.lit("-"), F.lit("/")),
            "crypto_id": F.coalesce("crypto_id", F.lit("unknown")),
        }
    )


def with_aggregate_keys(aggregates: DataFrame, as_of) -> DataFrame:
    """Partition keys of aggregates: day of the window start."""
    start = F.coalesce("window_start", at_time(as_of, aggregates, "window_start"))
    return aggregates.withColumns(
        {"date_path": day_path(start), "crypto_id": F.coalesce("crypto_id", F.lit("unknown"))}
    )


def partition_counts(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("date_path", "crypto_id").agg(F.count(F.lit(1)).alias("row_count"))


# ---- expiring tables --------------------------------------------------------------
def with_expiry(rows: DataFrame, as_of, ttl_seconds: int = 300) -> DataFrame:
    now = F.lit(str(as_of)).cast("timestamp")
    return rows.withColumns(
        {
            "cached_at": now,
            "expires_at": F.timestamp_add("SECOND", F.lit(ttl_seconds), now),
            "ttl_seconds": F.lit(ttl_seconds),
        }
    )


def ttl_live(entries: DataFrame, as_of) -> DataFrame:
    """Entries that have not expired; the moment of expiry itself still counts as live."""
    return entries.filter(F.col("expires_at") >= at_time(as_of, entries, "expires_at"))


def ttl_purge_count(entries: DataFrame, as_of) -> DataFrame:
    gone = F.col("expires_at") < at_time(as_of, entries, "expires_at")
    return entries.agg(
        count_where(gone).alias("purged"), (F.count(F.lit(1)) - count_where(gone)).alias("kept")
    )
