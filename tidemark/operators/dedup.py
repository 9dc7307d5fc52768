"""Keep-first, insert-if-absent and upsert without a transactional table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The first row of every key. Copies of one key are combined before the shuffle."""
    return _pick(df, keys, F.min_by, arrival)


def keep_last(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The last row of every key."""
    return _pick(df, keys, F.max_by, arrival)


def _pick(df: DataFrame, keys: Sequence[str], choose, arrival: str) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(choose(F.struct(*rest), F.col(arrival)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def new_rows(
    incoming: DataFrame, target: DataFrame, keys: Sequence[str], arrival: str
) -> DataFrame:
    """Incoming rows an insert-if-absent adds: first of each key, key not in the target.

    A row with a null in its key equals nothing, so each of them is added.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    keyed = keep_first(incoming.filter(complete), keys, arrival)
    fresh = keyed.join(target.select(*keys), list(keys), "left_anti")
    return fresh.unionByName(incoming.filter(~complete))


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], arrival: str
) -> DataFrame:
    added = new_rows(incoming, target, keys, arrival)
    return target.unionByName(added.select(*target.columns))


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with changed keys replaced: the later load wins."""
    loads = target.withColumn("_load", F.lit(0)).unionByName(changes.withColumn("_load", F.lit(1)))
    return keep_last(loads, keys, "_load").drop("_load")


def prepare_prices(incoming: DataFrame, default_source: str = "coingecko") -> DataFrame:
    """Warehouse form of price events: fallbacks for time and source."""
    stamp: Column = F.col("event_timestamp")
    if "timestamp" in incoming.columns:
        stamp = F.coalesce(stamp, F.col("timestamp").cast(incoming.schema["event_timestamp"].dataType))
    out = incoming.withColumn("event_timestamp", stamp)
    return out.withColumn("source", F.coalesce("source", F.lit(default_source))).drop("timestamp")


def sync_alerts(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append alerts with their creation time, each full row once."""
    return target.unionByName(incoming.select(*target.columns)).dropDuplicates()
