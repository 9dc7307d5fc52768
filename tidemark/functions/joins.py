"""Joins against small sides whose size is checked, not assumed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidemark.session import pin

#: A side of a join is broadcast up to so many bytes, as measured.
BROADCAST_BYTES = 32 << 20


def measured_bytes(df: DataFrame) -> int | None:
    """Bytes of the rows, about: 16 for each row and column, and the text in them. None if there are no rows."""
    each = F.lit(16 * (1 + len(df.columns))).cast("long")
    for f in df.schema:
        if isinstance(f.dataType, (StringType, BinaryType)):
            each = each + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif f.dataType.typeName() in ("array", "map", "struct"):
            each = each + F.coalesce(F.octet_length(F.to_json(f.name)), F.lit(0))
    return df.agg(F.sum(each)).first()[0]


def sized(held: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A pinned frame, marked for broadcast if it is small; without rows it is a constant the optimizer sees."""
    size = measured_bytes(held)
    if size is None:
        return held.filter(F.lit(False))
    return F.broadcast(held) if size <= limit_bytes else held


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    limit_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join `big` with an aggregated side.

    The side is computed once and measured. Up to `limit_bytes` it is broadcast and the big side
    is not shuffled; beyond that it is a shuffled join, where adaptive execution splits hot keys.
    """
    return big.join(sized(pin(small), limit_bytes), on, how)


def with_zero_rows(counts: DataFrame, zeros: DataFrame, *keys: str) -> DataFrame:
    """Grouped sums in which the groups of `zeros` appear even when they have no row."""
    sums = [c for c in counts.columns if c not in keys]
    return (
        counts.unionByName(zeros)
        .groupBy(*keys)
        .agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])
    )
