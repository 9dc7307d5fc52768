"""Column expressions; all of them are built-ins and stay inside code generation."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_time(as_of: datetime | str, df: DataFrame, column: str) -> Column:
    """`as_of` as a literal of the column's own type, so that filters reach the scan uncast."""
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast(df.schema[column].dataType)


def clean_number(c: Column | str) -> Column:
    """NaN becomes null: in Spark NaN compares greater than any number."""
    return F.nanvl(F.col(c) if isinstance(c, str) else c, F.lit(None).cast("double"))


def without_nan(df: DataFrame, *columns: str) -> DataFrame:
    """`df` with NaN as null in those of the columns that are floating point."""
    there = {f.name: f.dataType.typeName() for f in df.schema}
    cleaned = {c: clean_number(c) for c in columns if there.get(c) in ("double", "float")}
    return df.withColumns(cleaned) if cleaned else df


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def share_pct(part: Column, whole: Column, digits: int, empty: float) -> Column:
    """part / whole in percent, with the value an empty group reports."""
    pct = F.round(part / F.when(whole > 0, whole) * 100.0, digits)
    return F.coalesce(pct, F.lit(empty))


def epoch_seconds(c: Column | str) -> Column:
    """Seconds since the epoch with microseconds kept."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp")) / F.lit(1_000_000.0)


def parsed_time(c: Column | str) -> Column:
    """ISO timestamp or null. The shape check rejects what a bare cast would accept ('10:00')."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(c))


def decimal_text(c: Column) -> Column:
    """A double as plain decimal text (20000000.0, not 2.0E7)."""
    plain = F.regexp_replace(c.cast("decimal(38,10)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    magnitude = F.abs(c)
    scientific = ((magnitude >= 1e7) & (magnitude < 1e16)) | (
        (magnitude < 1e-3) & (magnitude >= 1e-4)
    )
    return F.when(scientific, plain).otherwise(c.cast("string"))
