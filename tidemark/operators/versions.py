"""Content versions, listing and rollback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import lookup_join
from tidemark.schema import ROLLBACK_STEPS, TRACKED_IDS


def version_id(crypto_id: Column, date: Column, data: Column) -> Column:
    """First eight hex digits over asset, date and the JSON text of the data."""
    return F.substring(F.md5(F.concat(crypto_id, date.cast("string"), data)), 1, 8)


def canonical_json(*columns: str) -> Column:
    """Row as JSON text with its fields in alphabetical order."""
    return F.to_json(F.struct(*sorted(columns)))


def snapshots(rows: DataFrame, step: str, time: str, columns: Sequence[str]) -> DataFrame:
    """Every row as a versioned snapshot of its asset and day."""
    date, data = F.to_date(time), canonical_json(*columns)
    return rows.select(
        date.alias("date"),
        F.lit(step).alias("step"),
        "crypto_id",
        version_id(F.col("crypto_id"), date, data).alias("version_id"),
        data.alias("data"),
        F.col(time).alias("created_at"),
    )


def list_versions(snaps: DataFrame, crypto_id: str, step: str, date: str) -> DataFrame:
    return snaps.filter(
        (F.col("date") == F.lit(date).cast("date"))
        & (F.col("step") == step)
        & (F.col("crypto_id") == crypto_id)
    ).select("version_id", "created_at")


def version_counts(snaps: DataFrame, step: str = "consume") -> DataFrame:
    """Versions and the number of assets that have any; grouped by asset first."""
    per_asset = snaps.filter(F.col("step") == step).groupBy("crypto_id").agg(
        F.count(F.lit(1)).alias("_n")
    )
    return per_asset.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_versions"),
        F.count("crypto_id").alias("assets_with_versions"),
    )


def check_rollback(
    crypto_id: str, step: str, version: str, tracked: Sequence[str] = TRACKED_IDS
) -> None:
    if crypto_id not in tracked:
        raise ValueError(f"unknown asset {crypto_id!r}")
    if step not in ROLLBACK_STEPS:
        raise ValueError(f"unknown step {step!r}")
    if len(version) != 8:
        raise ValueError("a version id has exactly 8 characters")


_TARGET = ["crypto_id", "step", "date", "version_id"]


def rollback(snaps: DataFrame, targets: DataFrame) -> DataFrame:
    """Snapshots of the wanted versions; nothing for a version that does not exist."""
    return lookup_join(snaps, targets.select(*_TARGET).distinct(), _TARGET, "left_semi")


def rollback_one(
    snaps: DataFrame, crypto_id: str, step: str, version: str, date: str,
    tracked: Sequence[str] = TRACKED_IDS,
) -> DataFrame:
    check_rollback(crypto_id, step, version, tracked)
    return snaps.filter(
        (F.col("date") == F.lit(date).cast("date"))
        & (F.col("step") == step)
        & (F.col("crypto_id") == crypto_id)
        & (F.col("version_id") == version)
    )


def first_versions(snaps: DataFrame) -> DataFrame:
    return _edge_version(snaps, F.min_by)


def current_versions(snaps: DataFrame) -> DataFrame:
    return _edge_version(snaps, F.max_by)


def _edge_version(snaps: DataFrame, choose) -> DataFrame:
    return snaps.groupBy("crypto_id", "step", "date").agg(
        choose("version_id", "created_at").alias("version_id")
    )


def rollback_preview(snaps: DataFrame, targets: DataFrame) -> DataFrame:
    """Dry run: current and wanted version of each target, and the snapshots made after it."""
    keys = ["crypto_id", "step", "date"]
    wanted = rollback(snaps, targets).groupBy(*keys).agg(
        F.min_by("version_id", "created_at").alias("target_version"),
        F.min("created_at").alias("_cut"),
    )
    return (
        lookup_join(snaps, wanted, keys, "inner")
        .groupBy(*keys, "target_version", "_cut")
        .agg(
            F.max_by("version_id", "created_at").alias("current_version"),
            F.count_if(F.col("created_at") > F.col("_cut")).alias("versions_undone"),
        )
        .select(*keys, "current_version", "target_version", "versions_undone")
    )
