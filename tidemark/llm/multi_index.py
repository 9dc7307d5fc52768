"""Inverted multi-index: two codebooks, one for each half of a vector, whose pairs form the cells.

Each vector half is quantised by itself, so K centroids a half make K * K cells. A query ranks the centroids
of each half by a score of its own and a heap gives the cells by the sum of both (the multi-sequence
walk): only cells on the frontier are held, no cell is looked at before one that is better.

* Codebooks are fitted on a bounded sample (`SAMPLE_ROWS` rows chosen by a hash), K grows with the root of the
  rows up to `MOST_CENTROIDS`. Every row is indexed.
* The driver sees the sample, the codebooks, and one number per cell (at most MOST_CENTROIDS squared).
* A visit is a shuffle by the first centroid. Rows of a centroid are dealt to blocks of about `BLOCK_ROWS`
  and the questions to it to blocks of about `BLOCK_ASKS`, from counts measured before, so a centroid that
  holds a third of all rows is many blocks, and a task holds one block of each kind.
* The index is pinned in the shared folder: a lost executor costs its running tasks only.

Rows without an id, with a null or empty vector, or with a component that is null or not finite are not indexed,
nor are vectors whose length isn't the most frequent one (ties: the shorter), as halves of other lengths
have no distance. Rows with equal ids are different rows; `row` numbers them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import pin

SAMPLE_ROWS = 32_768
MOST_CENTROIDS = 512
FIT_ROUNDS = 8
BLOCK_ROWS = 2_048
BLOCK_ASKS = 2_048

#: Makes a matrix of vectors of another one, row by row.
Form = Callable[[np.ndarray], np.ndarray]

INDEX = "row long, vec_id long, label long, vector binary, a int, b int, radius_a double, radius_b double"
INDEX_SCHEMA = pa.schema(
    [
        ("row", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("vector", pa.binary()),
        ("a", pa.int32()), ("b", pa.int32()), ("radius_a", pa.float64()), ("radius_b", pa.float64()),
    ]
)
#: A question: the cells of one first centroid `a` that a query visits, as one bit for each second centroid.
ASKS = "ask long, label long, a int, vector binary, cells binary, extra binary"
ASKS_SCHEMA = pa.schema(
    [
        ("ask", pa.int64()), ("label", pa.int64()), ("a", pa.int32()), ("vector", pa.binary()),
        ("cells", pa.binary()), ("extra", pa.binary()),
    ]
)


def numbered(df: DataFrame, id_col: str, vec_col: str, label: Column | None = None) -> DataFrame:
    """row, vec_id, label and vector (array<double>) of the rows that take part; not yet pinned."""
    vector = F.col(vec_col).cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("vec_id"),
        (F.lit(0) if label is None else label).cast("long").alias("label"),
        vector.alias("vector"),
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("vector") > 0) & sound)
    return rows


def commonest_length(rows: DataFrame) -> tuple[int, int]:
    """The most frequent vector length and how many rows have it; (0, 0) without rows."""
    best = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return (best["d"], best["count"]) if best else (0, 0)


def matrix(column: pa.Array | pa.ChunkedArray, kind: str = "<f8") -> np.ndarray:
    """Vectors of equal length, stored as bytes, as rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1).astype(np.float64, copy=False)


def list_matrix(column: pa.Array) -> np.ndarray:
    """Vectors of equal length, stored as lists, as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = (x * x).sum(1)[:, None] + (centroids * centroids).sum(1)[None, :] - 2 * (x @ centroids.T)
    return np.maximum(out, 0)


def fitted(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's k-means from evenly spread distinct rows; empty centroids stay where they are."""
    distinct = np.unique(x, axis=0)
    k = max(1, min(k, len(distinct)))
    order = np.random.default_rng(7).permutation(len(distinct))[:k]
    centroids = distinct[order].copy()
    for _ in range(FIT_ROUNDS):
        nearest = np.concatenate([squared_distances(p, centroids).argmin(1) for p in pieces(x)])
        sums, counts = np.zeros_like(centroids), np.bincount(nearest, minlength=k)
        np.add.at(sums, nearest, x)
        some = counts > 0
        centroids[some] = sums[some] / counts[some, None]
    return centroids


def pieces(x: np.ndarray, size: int = 4096) -> Iterator[np.ndarray]:
    for i in range(0, max(len(x), 1), size):
        yield x[i : i + size]


@dataclass
class Books:
    """The codebooks of both halves, and what is known of each cell: rows, and the largest radius of a centroid."""

    half: int
    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray
    radius_a: np.ndarray
    radius_b: np.ndarray

    def split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half], x[:, self.half :]


@dataclass
class Index:
    rows: DataFrame
    books: Books


def quantised(half: int, first: np.ndarray, second: np.ndarray, stored: Form, coded: Form):
    """A function for mapInArrow: the cell of each vector and its distances from both centroids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            kept = stored(list_matrix(batch.column("vector")))
            x = coded(kept)
            found = [squared_distances(x[:, :half], first), squared_distances(x[:, half:], second)]
            cells = [d.argmin(1) for d in found]
            radii = [np.sqrt(d[np.arange(len(d)), c]) for d, c in zip(found, cells)]
            flat = np.ascontiguousarray(kept, "<f8")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("vec_id"), batch.column("label"),
                    pa.array([v.tobytes() for v in flat], pa.binary()),
                    pa.array(cells[0].astype(np.int32)), pa.array(cells[1].astype(np.int32)),
                    pa.array(radii[0]), pa.array(radii[1]),
                ],
                schema=INDEX_SCHEMA,
            )

    return run


def build(
    rows: DataFrame,
    stored: Form,
    coded: Form,
    centroids: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
) -> Index | None:
    """The pinned index over all `rows` of `numbered`; None if there are none.

    `stored` makes of a matrix of given vectors what is kept, `coded` of that what is quantised.
    """
    length, n = commonest_length(rows)
    if not n:
        return None
    rows = rows.filter(F.size("vector") == length)
    share = min(1.0, sample_rows / n)
    drawn = rows if share == 1.0 else rows.filter(F.pmod(F.xxhash64("row", F.lit(11)), F.lit(1 << 20)) < share * (1 << 20))
    # About `sample_rows` rows; half as many again would be far beyond chance.
    sample = np.array([r["vector"] for r in drawn.select("vector").limit(sample_rows * 3 // 2).collect()], np.float64)
    sample = coded(stored(sample)) if len(sample) else np.zeros((1, length))
    k = centroids or max(1, min(MOST_CENTROIDS, round(math.sqrt(n) / 4)))
    half = length // 2
    first, second = fitted(sample[:, :half], k), fitted(sample[:, half:], k)
    held = pin(rows.mapInArrow(quantised(half, first, second, stored, coded), INDEX))
    cells = held.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.max("radius_a").alias("ra"), F.max("radius_b").alias("rb")
    )
    counts = np.zeros((len(first), len(second)), np.int64)
    radius_a, radius_b = np.zeros(len(first)), np.zeros(len(second))
    for r in cells.collect():  # one row per cell, at most MOST_CENTROIDS squared
        counts[r["a"], r["b"]] = r["n"]
        radius_a[r["a"]] = max(radius_a[r["a"]], r["ra"])
        radius_b[r["b"]] = max(radius_b[r["b"]], r["rb"])
    return Index(held, Books(half, first, second, counts, radius_a, radius_b))


def walk(costs_a: np.ndarray, costs_b: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """All pairs (a, b) by rising cost of a plus cost of b, by the multi-sequence heap.

    A pair enters the heap once both its better neighbours have left it.
    """
    order_a, order_b = np.argsort(costs_a, kind="stable"), np.argsort(costs_b, kind="stable")
    x, y = costs_a[order_a].tolist(), costs_b[order_b].tolist()
    order_a, order_b = order_a.tolist(), order_b.tolist()
    rows, columns = len(x), len(y)
    # How far each row and each column has been walked: pairs leave a row from left to right.
    done_in_row, done_in_column = [0] * rows, [0] * columns
    heap = [(x[0] + y[0], 0, 0)]
    push, pop = heapq.heappush, heapq.heappop
    while heap:
        cost, i, j = pop(heap)
        yield cost, order_a[i], order_b[j]
        done_in_row[i], done_in_column[j] = j + 1, i + 1
        if i + 1 < rows and done_in_row[i + 1] == j:
            push(heap, (x[i + 1] + y[j], i + 1, j))
        if j + 1 < columns and done_in_column[j + 1] == i:
            push(heap, (x[i] + y[j + 1], i, j + 1))


def questions(visited: dict[int, list[int]], width: int) -> Iterator[tuple[int, bytes]]:
    """The cells to visit as one bit row for each first centroid."""
    for a, found in visited.items():
        bits = np.zeros(width, np.uint8)
        bits[found] = 1
        yield a, np.packbits(bits).tobytes()


def bits_of(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Questions x second centroids, as booleans."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    return np.unpackbits(raw, axis=1, count=width).astype(bool)


def asking(
    select: Callable[[dict, np.ndarray], tuple[dict[int, list[int]], bytes]], books: Books
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow over rows with `row`, `label`, `vector` and more; `select` walks the cells."""
    width = len(books.second)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for r in batch.to_pylist():
                visited, extra = select(r, np.frombuffer(r["vector"], "<f8"))
                for a, cells in questions(visited, width):
                    out.append(
                        {"ask": r["row"], "label": r["label"], "a": a, "vector": r["vector"], "cells": cells, "extra": extra}
                    )
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema=ASKS_SCHEMA)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=ASKS_SCHEMA)

    return run


def visit(index: Index, asks: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """`work` gets a block of questions to one first centroid and a block of its rows, each pair of blocks once."""
    spark = asks.sparkSession
    asks = pin(asks)
    rows_of = index.books.counts.sum(1)
    asked = np.zeros(len(rows_of), np.int64)
    for r in asks.groupBy("a").count().collect():  # one row per first centroid
        asked[r["a"]] = r["count"]
    sizes = [
        (a, max(1, -(-int(rows_of[a]) // BLOCK_ROWS)), max(1, -(-int(asked[a]) // BLOCK_ASKS)))
        for a in range(len(rows_of))
        if asked[a]
    ]
    blocks = F.broadcast(spark.createDataFrame(sizes, "a int, row_blocks long, ask_blocks long"))

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        place = F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).alias(f"{own}_block")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1)).alias(f"{other}_block")
        return df.join(blocks, "a").select(*df.columns, place, every)

    left = dealt(asks, "ask", "ask", "row")
    right = dealt(index.rows.select("row", "vec_id", "label", "vector", "a", "b"), "row", "row", "ask")
    keys = ["a", "row_block", "ask_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score first, ties by smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        held = np.flatnonzero(scores >= least)
    else:
        held = np.arange(len(scores))
    return held[np.lexsort((ids[held], -scores[held]))][:k]
