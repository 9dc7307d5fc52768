"""Questions from chunks of documents to all others, answered by shuffles of packed keys.

Documents are dealt to chunks of bounded size by a hash of their id. A chunk's task turns its texts into
arrays, asks for some 64-bit keys (each once, whatever its number of occurrences, so no key is hot), and
gets answers back beside the same texts. A question is one row for each part of the key space: keys
as bytes, not as rows. The texts' exchange is the same each time and is reused by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

CHUNK_CHARS = 8_000_000
ASKED = "part long, chunk long, kind int, keys binary, data binary"
ASKED_SCHEMA = pa.schema(
    [("part", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("data", pa.binary())]
)


def dealt(docs: DataFrame, id_col: str, text_col: str, chunk_chars: int, *more) -> tuple[DataFrame, int]:
    """doc_id, text and chunk of each row; the number of chunks."""
    rows = common.documents(docs, id_col, text_col, *more)
    chars = rows.agg(F.sum(F.length("text").cast("long") + 1)).first()[0] or 0
    chunks = max(1, math.ceil(chars / chunk_chars))
    key = F.xxhash64("doc_id", F.length("text"))
    return rows.withColumn("chunk", F.pmod(key, F.lit(chunks))), chunks


def empty() -> pa.Table:
    return ASKED_SCHEMA.empty_table()


def asked(chunk: int, kind: int, keys: np.ndarray, parts: int, *columns: np.ndarray) -> list[dict]:
    """Rows for sorted distinct keys: the key space is cut into `parts` even ranges."""
    # A range of keys per part: the high bits, so that sorted keys stay sorted and lie together.
    place = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cuts = np.searchsorted(place, np.arange(parts + 1, dtype=np.uint64))
    out = []
    for part in range(parts):
        a, b = cuts[part], cuts[part + 1]
        if a < b:
            data = b"".join(np.ascontiguousarray(c[a:b]).tobytes() for c in columns)
            out.append({"part": part, "chunk": chunk, "kind": kind, "keys": keys[a:b].tobytes(), "data": data})
    return out


def table_of(rows: list[dict]) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=ASKED_SCHEMA) if rows else empty()


def column(table: pa.Table, name: str, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in table.column(name)]


def ask(texts: DataFrame, question: Callable[[pa.Table], list[dict]]) -> DataFrame:
    """`question` gets the texts of a chunk and returns rows as `asked` makes them."""
    return texts.groupBy("chunk").applyInArrow(lambda t: table_of(question(t)), ASKED)


def answer(questions: DataFrame, reply: Callable[[pa.Table], list[dict]]) -> DataFrame:
    """`reply` gets all questions to a part, and returns rows for the chunks."""
    return questions.groupBy("part").applyInArrow(lambda t: table_of(reply(t)), ASKED)


def beside(texts: DataFrame, answers: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """`work` gets the texts of a chunk with the answers to it."""
    return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(work, schema)


def small(array: np.ndarray) -> bytes:
    """Compressed: for counts, which are mostly one or none."""
    import zstandard

    return zstandard.compress(np.ascontiguousarray(array).tobytes(), 1)


def large(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.decompress(data), kind)


def six_bytes(keys: np.ndarray) -> bytes:
    """Keys without their two last bytes, which are zero."""
    return keys.view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def from_six(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, 2:] = raw.reshape(-1, 6)
    return wide.reshape(-1).view(np.uint64)


def gaps(keys: np.ndarray) -> bytes:
    """Sorted keys whose two last bytes are zero: their distances, compressed byte by byte."""
    steps = np.diff(keys >> np.uint64(16), prepend=np.uint64(0))
    return small(steps.view(np.uint8).reshape(-1, 8)[:, :6].T)


def from_gaps(data: bytes) -> np.ndarray:
    planes = large(data, np.uint8).reshape(6, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :6] = planes.T
    return np.cumsum(wide.view(np.uint64).reshape(-1), dtype=np.uint64) << np.uint64(16)


def to_all(totals: DataFrame, n_chunks: int) -> DataFrame:
    """Rows under negative chunk numbers, summed by number and then given to every chunk, as kind -1."""
    summed_up = totals.filter("chunk < 0").groupBy("chunk").agg(F.sum("part").alias("part"))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_chunks - 1).cast("long")))
    return summed_up.select(
        "part",
        everywhere.alias("chunk"),
        F.lit(-1).alias("kind"),
        F.col("chunk").cast("string").cast("binary").alias("keys"),
        F.lit(b"").alias("data"),
    )


def joined(arrays: list[np.ndarray], kind=np.uint64) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.zeros(0, kind)
