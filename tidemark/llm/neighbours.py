"""Approximate nearest neighbours by cosine over an inverted multi-index.

Unit vectors are indexed (`multi_index`); a query walks centroid pairs by their summed squared distance and
reranks all rows of the cells it visits by the cosine of the original vectors, in double precision.

How many occupied cells a query visits is learned, not given: for `TRIAL_QUERIES` rows, chosen by a hash, the
true neighbours are found by one brute-force pass over all rows, and the number of cells is the smallest that reaches
`REACH` of those neighbours. So recall is set by the data: few cells where vectors lie in clusters, many where
they fill the space evenly. The pass costs rows x TRIAL_QUERIES, in proportion to the rows.

Rows of equal vectors have equal scores, to the last bit: the score is a sum over each row by itself, matrix products
only choose candidates. Rows that take no part: see `multi_index`; also vectors that are zero. A row is never its
own neighbour, another row of its id is one. Fewer than k other rows: all of them. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import multi_index
from tidemark.session import pin

TRIAL_QUERIES = 128
REACH = 0.98
FOUND = "ask long, query_id long, row long, vec_id long, score double, a int, b int"
FOUND_SCHEMA = pa.schema(
    [
        ("ask", pa.int64()), ("query_id", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()),
        ("score", pa.float64()), ("a", pa.int32()), ("b", pa.int32()),
    ]
)
RESULT = "query_id long, rank int, vec_id long, score double"
#: Scores of matrix products differ from exact ones by far less.
MARGIN = 1e-9


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, which changes no cosine by a bit and keeps squares in range."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    return np.ldexp(x, -exponent[:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1))[:, None]


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The cosine of one vector with each row; a row's value depends on nothing but both vectors."""
    x, q = scaled(x), scaled(q[None, :])[0]
    return (x * q).sum(1) / np.sqrt((q * q).sum() * (x * x).sum(1))


def best_rows(q: np.ndarray, own: int, near: np.ndarray, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """Places and scores of the k nearest of `x`, whose approximate cosines are `near`."""
    near = np.where(rows == own, -np.inf, near)
    places = np.flatnonzero(near > -np.inf)
    if len(places) > k:
        least = np.partition(near[places], len(places) - k)[len(places) - k]
        places = places[near[places] >= least - MARGIN]
    exact = cosine(q, x[places])
    chosen = multi_index.first_of(exact, ids[places], k)
    return places[chosen], exact[chosen]


def table_of(found: list[tuple]) -> pa.Table:
    columns = list(zip(*found)) if found else [[]] * len(FOUND_SCHEMA)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, FOUND_SCHEMA)], schema=FOUND_SCHEMA)


def compared(k: int, width: int):
    """Each question of a block against the rows of its cells in a block."""

    def work(asks: pa.Table, rows: pa.Table) -> pa.Table:
        if not asks.num_rows or not rows.num_rows:
            return table_of([])
        q, x = multi_index.matrix(asks.column("vector")), multi_index.matrix(rows.column("vector"))
        open_cells = multi_index.bits_of(asks.column("cells"), width)
        cell, number = rows.column("b").to_numpy(), rows.column("row").to_numpy()
        ids, own = rows.column("vec_id").to_numpy(), asks.column("ask").to_numpy()
        first, names = rows.column("a").to_numpy(), asks.column("label").to_numpy()
        uq, ux = unit(q), unit(x)
        found: list[tuple] = []
        for i in range(0, len(q), 256):
            near = uq[i : i + 256] @ ux.T
            for j, line in enumerate(near, i):
                line = np.where(open_cells[j][cell], line, -np.inf)
                places, scores = best_rows(q[j], own[j], line, x, ids, number, k)
                found += [
                    (own[j], names[j], number[p], ids[p], s, first[p], cell[p]) for p, s in zip(places, scores)
                ]
        return table_of(found)

    return work


def against_all(trial: list[tuple[int, np.ndarray]], k: int):
    """A function for mapInArrow: the k best rows of a partition for each trial query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uq = unit(np.array([v for _, v in trial]))
        best: list[list[tuple]] = [[] for _ in trial]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = multi_index.matrix(batch.column("vector"))
            ids, number = batch.column("vec_id").to_numpy(), batch.column("row").to_numpy()
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            near = uq @ unit(x).T
            for t, (own, q) in enumerate(trial):
                places, scores = best_rows(q, own, near[t], x, ids, number, k)
                best[t] += [(own, 0, number[p], ids[p], s, a[p], b[p]) for p, s in zip(places, scores)]
                best[t] = sorted(best[t], key=lambda r: (-r[4], r[3]))[:k]
        yield from table_of([r for rows in best for r in rows]).to_batches()

    return run


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def cells_needed(index: multi_index.Index, k: int, trials: int, reach: float) -> int:
    """Occupied cells a query must visit so that a share `reach` of true neighbours lies in them."""
    books = index.books
    chosen = index.rows.orderBy(F.xxhash64("row", F.lit(3))).limit(trials).select("row", "vector").collect()
    trial = [(r["row"], np.frombuffer(r["vector"], "<f8")) for r in chosen]
    true = top(index.rows.mapInArrow(against_all(trial, k), FOUND), k).select("ask", "a", "b").collect()
    where: dict[int, list[tuple[int, int]]] = {}
    for r in true:  # at most trials x k rows
        where.setdefault(r["ask"], []).append((r["a"], r["b"]))
    needed = []
    for row, vector in trial:
        if row in where:
            costs = summed_costs(books, vector)
            filled = np.sort(costs[books.counts > 0])
            needed += [int(np.searchsorted(filled, costs[cell], side="right")) for cell in where[row]]
    return int(np.quantile(needed, reach, method="higher")) if needed else 1


def half_costs(books: multi_index.Books, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    one, two = books.split(unit(vector[None, :]))
    return multi_index.squared_distances(one, books.first)[0], multi_index.squared_distances(two, books.second)[0]


def summed_costs(books: multi_index.Books, vector: np.ndarray) -> np.ndarray:
    a, b = half_costs(books, vector)
    return a[:, None] + b[None, :]


def nearest_cells(books: multi_index.Books, cells: int):
    """Walks the heap until so many occupied cells are visited."""

    def select(_: dict, vector: np.ndarray) -> tuple[dict[int, list[int]], bytes]:
        visited: dict[int, list[int]] = {}
        left = cells
        for _cost, a, b in multi_index.walk(*half_costs(books, vector)):
            if books.counts[a, b]:
                visited.setdefault(a, []).append(b)
                left -= 1
                if not left:
                    break
        return visited, b""

    return select


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    centroids: int | None = None,
    trials: int = TRIAL_QUERIES,
    reach: float = REACH,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows found for each query; `is_query` is over `vec_id`."""
    rows = multi_index.numbered(vectors, id_col, vec_col)
    rows = rows.filter(F.exists("vector", lambda x: x != 0))
    index = multi_index.build(rows, np.asarray, unit, centroids)
    if index is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    cells = cells_needed(index, k, trials, reach)
    queries = index.rows.filter(is_query).select("row", F.col("vec_id").alias("label"), "vector")
    asks = queries.repartition("row").mapInArrow(
        multi_index.asking(nearest_cells(index.books, cells), index.books), multi_index.ASKS
    )
    found = multi_index.visit(index, asks, compared(k, len(index.books.second)), FOUND)
    return pin(top(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score"))

