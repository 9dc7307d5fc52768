"""Column helpers shared by the operators."""

from tidemark.functions.columns import (
    at_time,
    clean_number,
    count_where,
    decimal_text,
    epoch_seconds,
    parsed_time,
    share_pct,
    without_nan,
)
from tidemark.functions.joins import lookup_join, sized, with_zero_rows

__all__ = [
    "at_time",
    "clean_number",
    "count_where",
    "decimal_text",
    "epoch_seconds",
    "lookup_join",
    "parsed_time",
    "share_pct",
    "sized",
    "with_zero_rows",
    "without_nan",
]
