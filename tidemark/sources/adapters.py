"""Inputs of the operators built from the benchmark tables, which hold no market data.

Every adapter keeps all rows of its table; none of them filters or samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import PIPELINE_STEPS, STORAGE_PREFIXES

ASSET_IDS = ["click", "error", "purchase", "signup", "view"]
AS_OF = "2024-01-31 00:00:00"
#: Days up to that of AS_OF that hold the whole month; its own day is empty so far.
DAYS = 31
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"


def day_bounds(spark: SparkSession, folder: str) -> tuple[str, str]:
    """First and last day of the events, and so of everything made from them: two values."""
    found = table(spark, folder, "events").agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    return tuple(str(day) if day is not None else default for day, default in zip(found, (FIRST_DAY, LAST_DAY)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _change() -> Column:
    return (F.get_json_object("props", "$.k").cast("int") - 50).cast("double")


def prices(spark: SparkSession, folder: str) -> DataFrame:
    """Price events: one asset per event type."""
    return table(spark, folder, "events").select(
        "event_id",
        F.col("event_type").alias("crypto_id"),
        F.col("value").alias("price_usd"),
        (F.col("value") * 1e6).alias("market_cap_usd"),
        _change().alias("change_24h_pct"),
        F.col("ts").alias("event_timestamp"),
        F.lit("events").alias("source"),
    )


def order_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as prices of very many assets: one per customer."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("crypto_id"),
        F.col("o_totalprice").alias("price_usd"),
        F.lit(None).cast("double").alias("change_24h_pct"),
        F.col("o_orderdate").alias("event_timestamp"),
    )


def item_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Order items as prices: one asset per part, the discount as its change."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("crypto_id"),
        F.col("l_extendedprice").alias("price_usd"),
        (F.col("l_discount") * 100).alias("change_24h_pct"),
        F.col("l_shipdate").alias("event_timestamp"),
    )


def assets(spark: SparkSession, folder: str) -> DataFrame:
    """Asset dimension: the distinct event types with a derived symbol and mechanism."""
    consensus = F.when(F.col("crypto_id") < "f", "Proof of Work").otherwise("Proof of Stake")
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("crypto_id"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "crypto_id",
            F.upper(F.substring("crypto_id", 1, 3)).alias("symbol"),
            F.lit("Cryptocurrency").alias("category"),
            consensus.alias("consensus_mechanism"),
        )
    )


def iso_text(c: Column | str) -> Column:
    """Timestamp as ISO text with microseconds and offset."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def raw_json(spark: SparkSession, folder: str) -> DataFrame:
    """Price events as JSON text, with a fault in some of them."""
    fault = F.col("event_id") % 17
    crypto = F.when(fault == 3, "unknown_coin").when(fault != 1, F.col("crypto_id"))
    price = (
        F.when(fault == 2, -F.col("price_usd"))
        .when(fault == 5, F.lit(2e7))
        .when(fault != 8, F.col("price_usd"))
    )
    change = F.when(fault == 6, F.lit(5000.0)).otherwise(F.col("change_24h_pct"))
    stamp = (
        F.when(fault == 4, "not-a-date")
        .when(fault == 7, "10:00")
        .when(fault != 9, iso_text("event_timestamp"))
    )
    event = F.struct(
        crypto.alias("crypto_id"),
        price.alias("price_usd"),
        F.col("market_cap_usd"),
        change.alias("change_24h_pct"),
        stamp.alias("timestamp"),
        F.col("source"),
    )
    return prices(spark, folder).select(
        "event_id", F.to_json(event).alias("value"), F.col("event_timestamp").alias("received_at")
    )


def quote_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Live payloads `{id: {usd, ...}}`, each with one untracked asset; some lack the cap."""
    p = prices(spark, folder)
    cap = F.when(F.col("change_24h_pct") >= 0, F.col("market_cap_usd"))
    quote = F.struct(
        F.col("price_usd").alias("usd"),
        cap.alias("usd_market_cap"),
        F.col("change_24h_pct").alias("usd_24h_change"),
    )
    body = F.to_json(F.create_map(F.col("crypto_id"), quote, F.lit("untracked"), quote))
    return p.select("event_id", F.col("event_timestamp").alias("fetched_at"), body.alias("body"))


def history_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Historical payloads `{"prices": [[ms, price], ...]}` with two pairs each."""
    ms = F.unix_millis(F.col("event_timestamp").cast("timestamp"))
    price = F.col("price_usd").cast("string")
    body = F.concat(
        F.lit('{"prices": [['), ms.cast("string"), F.lit(", "), price, F.lit("], ["),
        (ms + 1).cast("string"), F.lit(", "), price, F.lit("]]}"),
    )
    return prices(spark, folder).select("crypto_id", body.alias("body"))


def step_metrics(spark: SparkSession, folder: str) -> DataFrame:
    names = F.array(*[F.lit(s) for s in PIPELINE_STEPS])
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, folder, "events").select(
        F.element_at(names, (F.col("user_id") % 6 + 1).cast("int")).alias("step"),
        F.col("event_type").alias("crypto_id"),
        F.when(k < 8, "failure").otherwise("success").alias("status"),
        (F.col("value") / 100).alias("duration_seconds"),
        F.col("ts").alias("recorded_at"),
    )


def sla_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements of six known service levels; user ids divisible by seven name an unknown one."""
    sla = F.when(F.col("user_id") % 7 == 0, "S099").otherwise(
        F.concat(F.lit("S00"), (F.col("user_id") % 6 + 1).cast("string"))
    )
    return table(spark, folder, "events").select(
        sla.alias("sla_id"), F.col("value").alias("actual_seconds"), F.col("ts").alias("recorded_at")
    )


def audit_actions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_type").alias("action"),
        F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("resource"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("actor"),
        F.col("ts").alias("timestamp"),
    )


def headlines(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts as headlines; the language stands for the asset."""
    return table(spark, folder, "documents").select(
        "doc_id", F.col("lang").alias("crypto_id"), F.col("text").alias("headline")
    )


def objects(spark: SparkSession, folder: str) -> DataFrame:
    """Storage inventory: one object per page."""
    names = F.array(*[F.lit(p) for p in STORAGE_PREFIXES])
    prefix = F.element_at(names, (F.col("page_id") % 4 + 1).cast("int"))
    modified = F.timestamp_add("DAY", (F.col("page_id") % 60).cast("int"), F.lit(f"{FIRST_DAY} 00:00:00").cast("timestamp_ntz"))
    return table(spark, folder, "pages").select(
        prefix.alias("prefix"),
        F.concat(prefix, F.lit("page_"), F.col("page_id").cast("string")).alias("key"),
        F.length("html").cast("bigint").alias("size"),
        modified.alias("last_modified"),
    )


def cache_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Cached results with a lifetime of 0 to 99 quarter days."""
    k = F.get_json_object("props", "$.k").cast("int")
    ttl = k * 21600
    return table(spark, folder, "events").select(
        F.concat(F.lit("key_"), F.col("event_id").cast("string")).alias("key"),
        F.col("ts").alias("cached_at"),
        F.timestamp_add("SECOND", ttl, F.col("ts")).alias("expires_at"),
        ttl.alias("ttl_seconds"),
        F.col("props").alias("data"),
    )


def host_samples(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("sample_id"),
        k.alias("cpu_percent"),
        (F.col("value") % 100).alias("memory_percent"),
        (F.lit(99.0) - k).alias("disk_percent"),
    )


def portfolio(spark: SparkSession) -> DataFrame:
    """Allocations over the stand-in assets."""
    return spark.createDataFrame(
        list(zip(ASSET_IDS, [0.5, 0.3, 0.1, 0.05, 0.05])), "crypto_id string, allocation double"
    )
