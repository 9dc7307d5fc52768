"""Readers of landed payloads: stream values, live quotes, history, headlines, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions import at_time, parsed_time
from tidemark.schema import HISTORY_PAYLOAD, PRICE_EVENT, QUOTE_PAYLOAD, TRACKED_IDS


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to event columns; the text is kept for the dead letters, other columns pass.

    Works on batch and streaming frames. Text that is not JSON gives null fields, which the
    validator rejects.
    """
    others = [c for c in raw.columns if c != value]
    text = F.col(value).cast("string")
    return raw.select(*others, text.alias("raw"), parsed_once(text, PRICE_EVENT))


def parsed_once(text: Column, schema: StructType) -> Column:
    """The fields of a JSON text as columns.

    A generator keeps filters on the fields above the parse; pushed below, each field they use
    would parse the text again.
    """
    return F.inline_outer(F.array(F.from_json(text, schema)))


def with_event_time(events: DataFrame) -> DataFrame:
    """Event time from the ISO text; null, not an error, where the text is malformed."""
    return events.withColumn("event_timestamp", parsed_time("timestamp"))


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Topic as a stream. The checkpoint of the query takes the place of consumer-group offsets."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    return reader.options(**options).load().select(
        "value", F.col("timestamp").alias("received_at"), "partition", "offset"
    )


def arrival(events: DataFrame) -> Column:
    """The order in which events came, for keep-first.

    From a topic it is the time the topic took them in, then partition and offset, which no layout of files or
    tasks changes. Other sources have only the order of their rows.
    """
    given = [c for c in ("received_at", "partition", "offset") if c in events.columns]
    if "offset" in given:
        return F.struct(*given)
    return F.struct(*given, F.monotonically_increasing_id().alias("row"))


def read_landed_json(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A folder of JSON lines as a stream of text values."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def flatten_quotes(
    payloads: DataFrame,
    tracked: Sequence[str] = TRACKED_IDS,
    body: str = "body",
    fetched_at: str = "fetched_at",
    source: str = "coingecko",
) -> DataFrame:
    """Live payload `{id: {usd, usd_market_cap, usd_24h_change}}` to one event per tracked id."""
    others = [c for c in payloads.columns if c not in (body, fetched_at)]
    return (
        payloads.select(
            *others,
            F.col(fetched_at).alias("event_timestamp"),
            F.explode(F.from_json(body, QUOTE_PAYLOAD)).alias("crypto_id", "_q"),
        )
        .filter(F.col("crypto_id").isin(list(tracked)))
        .select(
            *others,
            "crypto_id",
            F.col("_q.usd").alias("price_usd"),
            F.col("_q.usd_market_cap").alias("market_cap_usd"),
            F.col("_q.usd_24h_change").alias("change_24h_pct"),
            "event_timestamp",
            F.lit(source).alias("source"),
        )
    )


def backfill_events(payloads: DataFrame, body: str = "body") -> DataFrame:
    """Historical payload `{prices: [[ms, price], ...]}` to events without cap and change."""
    return payloads.select(
        "crypto_id", F.explode(F.from_json(body, HISTORY_PAYLOAD)["prices"]).alias("_p")
    ).select(
        "crypto_id",
        F.col("_p")[1].alias("price_usd"),
        F.lit(None).cast("double").alias("market_cap_usd"),
        F.lit(None).cast("double").alias("change_24h_pct"),
        F.timestamp_millis(F.col("_p")[0].cast("bigint")).alias("event_timestamp"),
        F.lit("coingecko_historical").alias("source"),
    )


def headlines_with_title(headlines: DataFrame, title: str = "headline") -> DataFrame:
    return headlines.filter(F.col(title).isNotNull() & (F.col(title) != ""))


def read_lake(
    spark: SparkSession, folder: str, schema=None, fmt: str = "parquet", **equals: str
) -> DataFrame:
    """One lake dataset; equality on `date`, `step`, `crypto_id` prunes partitions.

    JSON rows that do not parse are dropped one by one.
    """
    reader = spark.read.format(fmt)
    if fmt == "json":
        full = StructType([*schema, StructField("_corrupt", StringType())])
        df = (
            reader.schema(full)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt")
            .load(folder)
            .filter("_corrupt is null")
            .drop("_corrupt")
        )
    else:
        df = (reader.schema(schema) if schema is not None else reader).load(folder)
    return where_equal(df, **equals)


def where_equal(df: DataFrame, **equals: str | None) -> DataFrame:
    for column, wanted in equals.items():
        if wanted is not None:
            df = df.filter(F.col(column) == wanted)
    return df


def since(df: DataFrame, column: str, as_of, hours: float) -> DataFrame:
    """Rows of the last `hours` before `as_of`; no upper bound, like every reader of the engine."""
    start = at_time(as_of, df, column) - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    return df.filter(F.col(column) >= start)


def recent_prices(prices: DataFrame, as_of, hours: float = 24) -> DataFrame:
    return since(prices, "event_timestamp", as_of, hours).select(
        "crypto_id", "price_usd", "market_cap_usd", "change_24h_pct", "event_timestamp", "source"
    ).orderBy("event_timestamp", "crypto_id")


def recent_alerts(alerts: DataFrame, as_of, hours: float = 24) -> DataFrame:
    return since(alerts, "created_at", as_of, hours).select(
        "crypto_id", "alert_type", "message", "price_usd", "created_at"
    ).orderBy("created_at", "crypto_id")


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None, **options: str
) -> DataFrame:
    """Operational table over JDBC: filters and columns are pushed into the query."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        reader = reader.option("partitionColumn", partition_column)
    return reader.options(**options).load()


def day_path(c: Column) -> Column:
    return F.date_format(c, "yyyy/MM/dd")
