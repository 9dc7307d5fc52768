"""Ordered computations over long series.

A plain window over one asset puts the whole series of that asset into one task. Here a series longer than
`rows_per_segment` is cut into segments, and windows run per (key, segment). The few rows at the head of a
segment, whose frame reaches back into the segment before, are computed once more over the edge rows only
(first and last `lookback` rows of every segment), so results equal those of the plain window.

The cuts come from a histogram of time: rows per key and day, and days that hold too many rows counted
again in finer buckets, as often as needed. Running sums over a key's buckets give each its segment. Counts are
exact, so segments do not depend on the order in which tasks end, and their number has no upper bound.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions import sized
from tidemark.session import pin

ROWS_PER_SEGMENT = 2_000_000
DAY = 86_400_000_000
#: Segment of a row; rows of its series if that was cut, else 0.
SEG, CUT_ROWS = "_segment", "_cut_rows"
_AT, _START, _WIDTH, _N = "_position", "_start", "_width", "_n"


@dataclass(frozen=True)
class Series:
    """Rows with their segment. Segment 0 is the first one of a series; later numbers rise, with gaps.

    Without a cut every row is in segment 0, so there are no heads to compute again.
    """

    rows: DataFrame
    keys: tuple[str, ...]
    order: str
    cut: bool

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, SEG).orderBy(self.order)

    def whole(self) -> WindowSpec:
        """All rows of a segment, over the same ordering and hence the same shuffle and sort."""
        return self.window().rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing
        )


def segmented(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> Series:
    """Cut long series by `order`.

    A bucket of the histogram is refined into at least eight times as many as it would need if its rows lay
    evenly; buckets still too full are refined again, down to one microsecond. Rows of one instant stay together,
    so `(keys, order)` must be unique, as the table keys of the engine are. A segment then holds at
    most twice `rows_per_segment` rows. The histogram is pinned: one row per key and day, and a few per segment.
    """
    keys = tuple(keys)
    instant = F.unix_micros(F.col(order).cast("timestamp"))
    rows = df.withColumn(_AT, instant).withColumns(
        {_START: F.floor(F.col(_AT) / DAY) * DAY, _WIDTH: F.lit(DAY).cast("long")}
    )
    place = [*keys, _START]
    level = _histogram(rows, place)
    series = level.groupBy(*keys).agg(F.sum(_N).alias(CUT_ROWS))
    cut = (series.agg(F.max(CUT_ROWS)).first()[0] or 0) > rows_per_segment
    # Where no series is long there are no segments to look up, which the optimizer sees.
    long_keys = series.filter(F.col(CUT_ROWS) > rows_per_segment) if cut else series.filter(F.lit(False))
    buckets: DataFrame | None = None
    while True:
        full = (F.col(_N) > rows_per_segment) & (F.col(_WIDTH) > 1) & F.col(_START).isNotNull()
        done, full = level.filter(~full), level.filter(full)
        buckets = done if buckets is None else buckets.unionByName(done)
        if not cut or full.isEmpty():
            break
        parts = F.pow(2, F.ceil(F.log2(F.col(_N) / rows_per_segment)) + 3)
        finer = F.greatest(F.lit(1), F.floor(F.col(_WIDTH) / parts)).cast("long")
        rows = _beside(rows, sized(pin(full.select(*place, finer.alias("_finer")))), place)
        moved = F.col(_START) + F.floor((F.col(_AT) - F.col(_START)) / F.col("_finer")) * F.col("_finer")
        rows = rows.withColumns(
            {_START: F.coalesce(moved, _START), _WIDTH: F.coalesce("_finer", _WIDTH)}
        )
        level = _histogram(rows.filter("_finer is not null"), place)
        rows = rows.drop("_finer")

    by_key = Window.partitionBy(*keys).orderBy(_START).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(_N).over(by_key), F.lit(0))
    segments = (
        _beside(long_keys, buckets, keys)
        .withColumn(SEG, F.floor(before / rows_per_segment).cast("int"))
        .select(*place, SEG, CUT_ROWS)
    )
    placed = _beside(rows, sized(pin(segments)) if cut else segments, place)
    marks = [F.coalesce(c, F.lit(0)).alias(c) for c in (SEG, CUT_ROWS)]
    return Series(placed.select(*df.columns, *marks), keys, order, cut)


def _histogram(rows: DataFrame, place: Sequence[str]) -> DataFrame:
    counted = rows.groupBy(*place).agg(F.count(F.lit(1)).alias(_N), F.first(_WIDTH).alias(_WIDTH))
    return pin(counted)


def _beside(rows: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on columns that may be null."""
    named = table.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return rows.join(named, same, "left").drop(*[f"_on_{c}" for c in on])


def rolling(
    series: Series,
    lookback: int,
    columns: dict[str, Callable[[WindowSpec], Column]],
) -> DataFrame:
    """Add window columns whose frames reach at most `lookback` rows back."""
    local = series.window()
    if not series.cut:  # every row is in the first segment, there are no heads
        return _with(series.rows, columns, local).drop(SEG, CUT_ROWS)
    placed = series.rows.withColumns(
        {
            "_head": F.row_number().over(local),
            "_tail": F.count(F.lit(1)).over(series.whole()),
        }
    )
    # Both branches below use the same columns of `placed`, so they share one scan and one shuffle.
    inner = (F.col(CUT_ROWS) == 0) | (F.col(SEG) == 0) | (F.col("_head") > lookback)
    edge = (F.col(CUT_ROWS) > 0) & (
        (F.col("_head") <= lookback) | (F.col("_head") > F.col("_tail") - lookback)
    )
    by_series = Window.partitionBy(*series.keys).orderBy(series.order)
    settled = _with(placed, columns, local).filter(inner)
    heads = _with(placed.filter(edge), columns, by_series).filter(~inner)
    return settled.unionByName(heads).drop("_head", "_tail", SEG, CUT_ROWS)


def _with(df: DataFrame, columns: dict, window: WindowSpec) -> DataFrame:
    return df.withColumns({name: make(window) for name, make in columns.items()})
