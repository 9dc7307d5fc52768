"""Audit entries, filters and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import with_zero_rows
from tidemark.sources.adapters import iso_text
from tidemark.sources.landed import where_equal


def audit_entries(
    actions: DataFrame, details: Column | None = None, status: Column | None = None
) -> DataFrame:
    """Entries with an id hashed from action, resource and time."""
    stamp = iso_text("timestamp")
    empty = F.create_map().cast("map<string,string>")
    return actions.select(
        F.md5(F.concat("action", "resource", stamp)).alias("audit_id"),
        "action",
        "resource",
        "actor",
        F.coalesce(details, empty).alias("details") if details is not None else empty.alias("details"),
        (status if status is not None else F.lit("success")).alias("status"),
        "timestamp",
        F.to_date("timestamp").alias("date"),
    )


def ingestion_audit(events: DataFrame, action: str, time: str) -> DataFrame:
    """Audit entries of ingestion events: the resource is the asset, the actor the pipeline."""
    return audit_entries(
        events.select(
            F.lit(action).alias("action"),
            F.col("crypto_id").alias("resource"),
            F.lit("pipeline").alias("actor"),
            F.col(time).alias("timestamp"),
        )
    )


def audit_logs(
    entries: DataFrame, date: str | None = None, action: str | None = None, resource: str | None = None
) -> DataFrame:
    if date is not None:
        entries = entries.filter(F.col("date") == F.lit(date).cast("date"))
    return where_equal(entries, action=action, resource=resource)


def audit_report(entries: DataFrame) -> DataFrame:
    """Total, by action and by resource in one pass."""
    kind = (
        F.when(F.col("action").isNotNull(), "action")
        .when(F.col("resource").isNotNull(), "resource")
        .otherwise("total")
    )
    filled = entries.select(
        F.coalesce("action", F.lit("unknown")).alias("action"),
        F.coalesce("resource", F.lit("unknown")).alias("resource"),
    )
    counts = (
        filled.groupingSets([[F.col("action")], [F.col("resource")], []], "action", "resource")
        .agg(F.count(F.lit(1)).alias("entries"))
        .select(kind.alias("kind"), F.coalesce("action", "resource", F.lit("all")).alias("key"), "entries")
    )
    zero = entries.sparkSession.range(1).selectExpr("'total' kind", "'all' key", "0L entries")
    return with_zero_rows(counts, zero, "kind", "key")
