"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words, as a set of characters and as a regular expression.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
MASK = (1 << 64) - 1


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """The id, the text and the columns named, under fixed names; everything else is left behind."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        *more,
    )


def id_remainder(id_column: Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo: the fold of a document. Null ids have none."""
    return F.crc32(id_column.cast("string")) % modulus


def words_column(text: Column) -> Column:
    """The words of a text as an array; empty for null."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     "))
    return F.filter(F.split(plain, " "), lambda w: w != "")


# Long arrays and texts inside one row


def walked(items: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str, block: int = 128) -> Column:
    """What `step(at, item)`, which gives the next `at` and an array to add, adds from `at` = 0 on, in order.

    Spark copies an array to append to it. So `block` items at a time are walked into an array of their
    own, which keeps the copies short however many items there are; `kind` is the type of the result.
    """

    def one(a: Column, x: Column) -> Column:
        at, more = step(a["at"], x)
        return F.struct(at.cast("long").alias("at"), F.concat(a["out"], more).alias("out"))

    def several(done: Column, some: Column) -> Column:
        at = F.coalesce(F.get(done, F.size(done) - 1)["at"], F.lit(0).cast("long"))
        begin = F.struct(at.alias("at"), F.array().cast(kind).alias("out"))
        return F.concat(done, F.array(F.aggregate(some, begin, one)))

    numbers = F.sequence(F.lit(0), F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / block).cast("int"))
    blocks = F.transform(numbers, lambda k: F.slice(items, k * block + 1, block))
    begin = F.array().cast(f"array<struct<at: bigint, out: {kind}>>")
    return F.flatten(F.transform(F.aggregate(blocks, begin, several), lambda a: a["out"]))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)`, with the value made once a row, also where `use` needs it inside a loop."""
    return F.get(F.transform(F.array(value), use), 0)


def cut_out(text: Column, ranges: Column, block: int = 512) -> Column:
    """The pieces of the text at (start, end) in code points, end exclusive.

    The text is cut into blocks once, so that a piece is sought from its block and not from the start.
    """

    def pieces(blocks: Column) -> Column:
        def piece(r: Column) -> Column:
            first = F.floor(r["start"] / block).cast("int")
            n = F.greatest(F.floor((r["end"] - 1) / block).cast("int") - first + 1, F.lit(0))
            some = F.array_join(F.slice(blocks, first + 1, n), "")
            size = F.greatest(r["end"] - r["start"], F.lit(0)).cast("int")
            return F.substring(some, (r["start"] - first * block + 1).cast("int"), size)

        return F.transform(ranges, piece)

    return bound(F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{block}}}"), F.lit(0)), pieces)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, for tables that are costly to build."""
    name = "_tidemark_llm_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].kept = {}
    return sys.modules[name].kept


def cached(key: Any, build: Callable[[], Any]) -> Any:
    kept = worker_cache()
    if key not in kept:
        if len(kept) > 8:
            kept.clear()
        kept[key] = build()
    return kept[key]


def give_back() -> None:
    """Return the memory that Arrow holds in reserve; a worker stays alive when its task is over, beside the next stage's."""
    pa.default_memory_pool().release_unused()


def per_batch(function: Callable[[pa.RecordBatch], dict[str, Any]], schema: pa.Schema):
    """A function for mapInArrow that makes the columns of `schema` from each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[f.name], type=f.type) for f in schema], schema=schema
                )
        give_back()

    return run


# Rolling hashes of words


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word; SipHash, so that no text is known to collide."""
    import pandas as pd

    words = text.encode("utf-8", "surrogatepass").split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    held = np.empty(len(words), dtype=object)
    held[:] = words
    return pd.util.hash_array(held, categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: each input bit reaches each output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**n modulo 2**64; kept for the longest asked so far."""
    kept = worker_cache()
    have = kept.get(("powers", base))
    if have is None or len(have) <= n:
        have = np.full(max(n + 1, 1 << 16), base & MASK, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have)
        kept[("powers", base)] = have
    return have[: n + 1]


def rolling(hashes: np.ndarray, width: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash of each run of `width` neighbours, by differences of one running sum."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(base, n)[:n], out=total[1:])
    back = powers(pow(base, -1, 1 << 64), n)
    return mixed((total[width:] - total[:-width]) * back[: n - width + 1])


#: A side of a join is broadcast up to so many bytes, as measured.
BROADCAST_BYTES = 16 << 20


def size_checked(df: DataFrame, *text_columns: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df`, computed once, and marked for broadcast if it is small; otherwise left to a shuffled join."""
    from tidemark.session import pin

    held = pin(df)
    wide = 16 * len(df.columns)
    each = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text_columns), F.lit(wide))
    size = held.agg(F.sum(each.cast("long"))).first()[0] or 0
    return F.broadcast(held) if size <= limit else held


def written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder, for rows with texts: compressed, and read by column."""
    import uuid

    from tidemark.session import shared_dir

    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark, folder: str) -> None:
    """Remove a folder that this run has made in the shared store."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables of one run in the shared folder: compressed, read by column, and deleted when the run is over."""

    def __init__(self, spark) -> None:
        import uuid

        from tidemark.session import shared_dir

        self.spark, self.kept = spark, 0
        self.folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept += 1
        path = f"{self.folder}/{self.kept}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        delete(self.spark, self.folder)
