"""A user function over every event, with failing rows kept as dead letters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.session import ship_with_jobs


def map_events(events: DataFrame, function: Callable[[dict], dict], schema: str) -> DataFrame:
    """Apply `function` to each event; adds the text of the event and of its error, if any.

    A missing value reaches the function as None. Rows are processed batch by batch where they lie;
    order is not kept. `succeeded` and
    `failed_letters` give the two halves.
    """
    fields = StructType.fromDDL(schema)
    names = fields.names
    full = StructType([*fields, StructField("_event", StringType()), StructField("_error", StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.pop("_event").tolist()
            out = []
            records = batch.astype(object).where(batch.notna(), None).to_dict("records")
            for event, text in zip(records, texts):
                try:
                    result = function(event)
                    out.append([result.get(n) for n in names] + [text, None])
                except Exception as error:  # any fault of the user function is a dead letter
                    out.append([None] * len(names) + [text, f"{type(error).__name__}: {error}"])
            yield pd.DataFrame(out, columns=full.names)

    text = F.to_json(F.struct(*events.columns)).alias("_event")
    return events.select(*events.columns, text).mapInPandas(run, full)


def succeeded(mapped: DataFrame) -> DataFrame:
    return mapped.filter("_error is null").drop("_event", "_error")


def failed_letters(mapped: DataFrame) -> DataFrame:
    return mapped.filter("_error is not null").select(
        F.col("_event").alias("event"), F.col("_error").alias("error")
    )


ship_with_jobs(__name__)
