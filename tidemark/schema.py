"""Table schemas, keys and the fixed reference data of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S, _D, _TS, _B, _I, _L = (
    T.StringType(),
    T.DoubleType(),
    T.TimestampType(),
    T.BooleanType(),
    T.IntegerType(),
    T.LongType(),
)
PRICE = T.DecimalType(20, 8)
CAP = T.DecimalType(30, 2)
CHANGE = T.DecimalType(10, 4)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


# ---- wire formats -----------------------------------------------------------
PRICE_EVENT = _struct(
    ("crypto_id", _S),
    ("price_usd", _D),
    ("market_cap_usd", _D),
    ("change_24h_pct", _D),
    ("timestamp", _S),
    ("source", _S),
)
AGGREGATE_EVENT = _struct(
    ("crypto_id", _S),
    ("window_start", _S),
    ("window_end", _S),
    ("avg_price", _D),
    ("min_price", _D),
    ("max_price", _D),
    ("price_range", _D),
    ("avg_change_24h", _D),
    ("record_count", _L),
)
QUOTE_PAYLOAD = T.MapType(
    _S, _struct(("usd", _D), ("usd_market_cap", _D), ("usd_24h_change", _D))
)
HISTORY_PAYLOAD = _struct(("prices", T.ArrayType(T.ArrayType(_D))))

# ---- tables: name -> (schema, natural key, partition columns) ----------------
TABLES: dict[str, tuple[T.StructType, tuple[str, ...], tuple[str, ...]]] = {
    "crypto_prices": (
        _struct(
            ("crypto_id", _S, False),
            ("price_usd", PRICE),
            ("market_cap_usd", CAP),
            ("change_24h_pct", CHANGE),
            ("event_timestamp", _TS, False),
            ("source", _S),
            ("ingested_at", _TS),
            ("date", T.DateType()),
        ),
        ("crypto_id", "event_timestamp"),
        ("date",),
    ),
    "crypto_alerts": (
        _struct(
            ("crypto_id", _S),
            ("alert_type", _S),
            ("message", _S),
            ("price_usd", PRICE),
            ("created_at", _TS),
            ("date", T.DateType()),
        ),
        (),
        ("date",),
    ),
    "crypto_price_aggregates": (
        _struct(
            ("crypto_id", _S),
            ("window_start", _TS),
            ("window_end", _TS),
            ("avg_price", PRICE),
            ("min_price", PRICE),
            ("max_price", PRICE),
            ("price_range", PRICE),
            ("avg_change_24h", CHANGE),
            ("record_count", _I),
            ("created_at", _TS),
            ("date", T.DateType()),
        ),
        ("crypto_id", "window_start"),
        ("date",),
    ),
    "raw_crypto_prices": (
        _struct(
            ("crypto_id", _S),
            ("price_usd", PRICE),
            ("market_cap_usd", CAP),
            ("change_24h_pct", CHANGE),
            ("event_timestamp", _TS),
            ("source", _S),
            ("ingested_at", _TS),
            ("date", T.DateType()),
        ),
        ("crypto_id", "event_timestamp"),
        ("date",),
    ),
    "raw_crypto_alerts": (
        _struct(
            ("crypto_id", _S),
            ("alert_type", _S),
            ("message", _S),
            ("price_usd", PRICE),
            ("created_at", _TS),
            ("date", T.DateType()),
        ),
        (),
        ("date",),
    ),
    "crypto_daily_summary": (
        _struct(
            ("crypto_id", _S),
            ("avg_price", PRICE),
            ("min_price", PRICE),
            ("max_price", PRICE),
            ("total_volume", _L),
            ("alert_count", _I),
            ("created_at", _TS),
            ("trade_date", T.DateType()),
        ),
        ("crypto_id", "trade_date"),
        ("trade_date",),
    ),
}


def create_table_sql(name: str, database: str | None = None) -> str:
    """DDL of one engine table; unique keys are kept by the writers, not by a constraint."""
    schema, _, partition = TABLES[name]
    cols = ", ".join(
        f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema
    )
    target = f"{database}.{name}" if database else name
    return f"CREATE TABLE IF NOT EXISTS {target} ({cols}) USING parquet PARTITIONED BY ({', '.join(partition)})"


# ---- fixed values -----------------------------------------------------------
TRACKED_IDS = ["bitcoin", "ethereum", "solana", "cardano", "dogecoin"]

ASSETS = [
    ("bitcoin", "BTC", "Cryptocurrency", "Proof of Work"),
    ("ethereum", "ETH", "Cryptocurrency", "Proof of Stake"),
    ("solana", "SOL", "Cryptocurrency", "Proof of History"),
    ("cardano", "ADA", "Cryptocurrency", "Proof of Stake"),
    ("dogecoin", "DOGE", "Cryptocurrency", "Proof of Work"),
]

DEFAULT_PORTFOLIO = [
    ("bitcoin", 0.5),
    ("ethereum", 0.3),
    ("solana", 0.1),
    ("cardano", 0.05),
    ("dogecoin", 0.05),
]
TOTAL_INVESTMENT = 10_000.0

# (rule_id, name, metric, operator, threshold, severity)
ALERT_RULES = [
    ("A001", "extreme_pump", "change_24h_pct", ">", 20.0, "CRITICAL"),
    ("A002", "extreme_dump", "change_24h_pct", "<", -20.0, "CRITICAL"),
    ("A003", "moderate_pump", "change_24h_pct", ">", 10.0, "HIGH"),
    ("A004", "moderate_dump", "change_24h_pct", "<", -10.0, "HIGH"),
    ("A005", "high_volume", "volume_ratio", ">", 2.0, "MEDIUM"),
    ("A006", "price_above_sma", "price_vs_sma", ">", 5.0, "LOW"),
]
SEVERITY_COLORS = {"CRITICAL": "danger", "HIGH": "warning", "MEDIUM": "#439FE0", "LOW": "good"}

# (sla_id, name, max_seconds, description)
SLA_THRESHOLDS = [
    ("S001", "producer_latency", 60, "Price fetched within 60s"),
    ("S002", "consumer_latency", 30, "Event processed within 30s"),
    ("S003", "s3_upload_latency", 10, "S3 upload within 10s"),
    ("S004", "postgres_insert_latency", 5, "DB insert within 5s"),
    ("S005", "dashboard_refresh", 60, "Dashboard refreshes within 60s"),
    ("S006", "alert_delivery", 30, "Alert delivered within 30s"),
]

PIPELINE_STEPS = ["consume", "validate", "postgres", "s3", "alert", "spark_process"]
ROLLBACK_STEPS = ["consume", "validate", "aggregate", "s3", "snowflake"]
EXPECTED_DATASETS = ["raw", "aggregations", "sentiment", "technical", "monitoring"]
STORAGE_PREFIXES = ["raw/", "processed/", "monitoring/", "cache/"]

POSITIVE_KEYWORDS = ["bullish", "surge", "rise", "gain", "up", "record", "buy", "pump", "moon"]
NEGATIVE_KEYWORDS = ["bearish", "crash", "fall", "drop", "down", "sell", "dump", "ban", "hack"]

GRADE_FLOORS = [(90, "A"), (75, "B"), (60, "C"), (45, "D")]
STANDARD_COST_PER_GB = 0.023
COLD_COST_PER_GB = 0.004


def assets(spark: SparkSession) -> DataFrame:
    """Static dimension of tracked assets."""
    return spark.createDataFrame(
        ASSETS, "crypto_id string, symbol string, category string, consensus_mechanism string"
    )


def sla_thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SLA_THRESHOLDS, "sla_id string, name string, max_seconds int, description string"
    )


def steps(spark: SparkSession) -> DataFrame:
    """Pipeline steps with their order, which also breaks ties."""
    return spark.createDataFrame(
        list(enumerate(PIPELINE_STEPS)), "step_order int, step string"
    ).select("step", "step_order")


def portfolio_or_default(portfolio: DataFrame | None, spark: SparkSession) -> DataFrame:
    """The configured allocations, or the default ones when none are configured."""
    if portfolio is not None and not portfolio.isEmpty():
        return portfolio
    return spark.createDataFrame(DEFAULT_PORTFOLIO, "crypto_id string, allocation double")
