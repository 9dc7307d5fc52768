"""Hard-negative mining over an inverted multi-index, with certified results.

Vectors become integers, floor(scale * x); the score of a row for an anchor is their inner product. For
each anchor the best other rows of its label are its positives, and for each positive the best rows of other
labels whose score lies in a window between two shares of the positive's are its hard negatives.

A half of a vector in cell a lies within that centroid's radius, so its half-score is at most
q . c + |q| * radius. The heap (`multi_index.walk`) visits cells by falling sum of both bounds, and a
cell whose bound is below a score can't hold a row that reaches it. So results are exact:

1. *Probe.* Each anchor visits its first cells until they hold `PROBE_ROWS` rows. The scores found there are lower
   bounds of the true ones: of the last positive wanted.
2. *Positives.* It visits the other cells whose bound reaches that score. Its positives are then certain.
3. *Windows.* In all cells whose bound reaches the last positive, the best rows in each window are found: lower
   bounds of the last negative wanted.
4. *Negatives.* It visits the other cells whose bound reaches the lowest of those scores, or the window's floor if the window
   isn't full yet. Each window is then certified: no unvisited cell can change it.

Ties of scores go to the smaller id. Rows with equal ids are different rows, and each of them that is an anchor gives
its own results. Rows with a null label take no part, nor those named in `multi_index`. Fewer positives or negatives than wanted:
all there are. A positive with a score below zero has an empty window. An empty table gives no rows. Scores must fit in 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import multi_index
from tidemark.session import pin

PROBE_ROWS = 2_048
FOUND = "ask long, window long, row long, vec_id long, score long"
FOUND_SCHEMA = pa.schema(
    [("ask", pa.int64()), ("window", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
)
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
#: Sums of products of doubles below this are whole numbers without rounding.
EXACT = float(1 << 53)


def floored(scale: int) -> multi_index.Form:
    return lambda x: np.floor(scale * x)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly."""
    if q.size and x.size and np.abs(q).max() * np.abs(x).max() * q.shape[1] < EXACT:
        return (q @ x.T).astype(np.int64)
    return q.astype(np.int64) @ x.astype(np.int64).T


def negated_bounds(books: multi_index.Books, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minus the most that half of a row's score can be, for each centroid; a little more, for rounding."""
    out = []
    for q, centroids, radius in zip(
        books.split(vector[None, :]), (books.first, books.second), (books.radius_a, books.radius_b)
    ):
        reach = np.sqrt((q * q).sum()) * radius
        middle = centroids @ q[0]
        # Radii come from a difference of squares: their error is far below this share of the vectors' lengths.
        slack = 1e-6 * (np.sqrt((q * q).sum()) * (np.sqrt((centroids * centroids).sum(1)) + radius) + 1)
        out.append(-(middle + reach + slack))
    return out[0], out[1]


def occupied(books: multi_index.Books, vector: np.ndarray):
    """(bound, a, b, rows) of each cell with rows, by falling bound."""
    for cost, a, b in multi_index.walk(*negated_bounds(books, vector)):
        if books.counts[a, b]:
            yield -cost, a, b, int(books.counts[a, b])


def probing(books: multi_index.Books, probe_rows: int):
    def select(_: dict, vector: np.ndarray) -> tuple[dict[int, list[int]], bytes]:
        visited: dict[int, list[int]] = {}
        seen = 0
        for _bound, a, b, n in occupied(books, vector):
            if seen >= probe_rows:
                break
            visited.setdefault(a, []).append(b)
            seen += n
        return visited, b""

    return select


def between(books: multi_index.Books, probe_rows: int | None):
    """Cells whose bound is at least `low`; less those of the probe, or those whose bound is at least `high`.

    A null `low` asks for all cells, a null `high` leaves nothing out.
    """

    def select(r: dict, vector: np.ndarray) -> tuple[dict[int, list[int]], bytes]:
        visited: dict[int, list[int]] = {}
        seen = 0
        for bound, a, b, n in occupied(books, vector):
            if r["low"] is not None and bound < r["low"]:
                break
            probed = probe_rows is not None and seen < probe_rows
            seen += n
            if not probed and (r["high"] is None or bound < r["high"]):
                visited.setdefault(a, []).append(b)
        return visited, np.asarray(r["windows"] or [], np.int64).tobytes()

    return select


def scored(k: int, width: int, same_label: bool):
    """The best rows of a block for each question: of its label, or of other labels in each of its windows."""

    def work(asks: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        if asks.num_rows and rows.num_rows:
            q, x = multi_index.matrix(asks.column("vector")), multi_index.matrix(rows.column("vector"))
            open_cells = multi_index.bits_of(asks.column("cells"), width)
            cell, number = rows.column("b").to_numpy(), rows.column("row").to_numpy()
            ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
            own, label = asks.column("ask").to_numpy(), asks.column("label").to_numpy()
            extra = asks.column("extra").to_pylist()
            scores = products(q, x)
            for i, line in enumerate(scores):
                if same_label:
                    fits = open_cells[i][cell] & (labels == label[i]) & (number != own[i])
                    windows = [(0, None, None)]
                else:
                    fits = open_cells[i][cell] & (labels != label[i])
                    windows = np.frombuffer(extra[i], np.int64).reshape(-1, 3).tolist()
                places = np.flatnonzero(fits)
                held = line[places]
                for name, low, high in windows:
                    inside = places if low is None else places[(held >= low) & (held <= high)]
                    best = inside[multi_index.first_of(line[inside], ids[inside], k)]
                    if len(best):
                        one = np.ones(len(best), np.int64)
                        found.append((own[i] * one, name * one, number[best], ids[best], line[best]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
        return pa.Table.from_arrays([pa.array(c) for c in columns], schema=FOUND_SCHEMA)

    return work


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask", "window").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label: Column | None = None,
    n_positives: int = 5,
    n_negatives: int = 10,
    low_pct: int = 30,
    high_pct: int = 90,
    scale: int = 256,
    centroids: int | None = None,
    probe_rows: int = PROBE_ROWS,
) -> DataFrame:
    """Hard negatives of each anchor and positive; `is_anchor` is over `vec_id`, `label` over the given columns."""
    label = F.col("label") if label is None else label
    rows = multi_index.numbered(vectors, id_col, vec_col, label)
    index = multi_index.build(rows, floored(scale), np.asarray, centroids)
    if index is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    books, width = index.books, len(index.books.second)
    anchors = index.rows.filter(is_anchor).select("row", "label", "vector").repartition("row")

    def visit(asks: DataFrame, select: Callable, k: int, same_label: bool) -> DataFrame:
        asked = asks.mapInArrow(multi_index.asking(select, books), multi_index.ASKS)
        return best(multi_index.visit(index, asked, scored(k, width, same_label), FOUND), k)

    def last_of(found: DataFrame, k: int) -> DataFrame:
        """The score of the k-th row of each question and window; null if there are fewer."""
        full = F.count(F.lit(1)) >= k
        return found.groupBy("ask", "window").agg(F.when(full, F.min("score")).alias("last"))

    def asks_with(bounds: DataFrame) -> DataFrame:
        return anchors.join(bounds.withColumnRenamed("ask", "row"), "row", "left")

    probed = pin(visit(anchors, probing(books, probe_rows), n_positives, True))
    no_high, no_windows = F.lit(None).cast("long"), F.lit(None).cast("array<long>")
    bounds = last_of(probed, n_positives).select(
        "ask", F.col("last").alias("low"), no_high.alias("high"), no_windows.alias("windows")
    )
    others = visit(asks_with(bounds), between(books, probe_rows), n_positives, True)
    both = probed.drop("rank").unionByName(others.drop("rank"))
    positives = pin(best(both, n_positives))

    # Window w belongs to the positive of rank w + 1.
    p = F.col("score")
    named = positives.filter(p >= 0).select(
        "ask",
        "score",
        (F.col("rank") - 1).cast("long").alias("window"),
        F.ceil(_share(p, low_pct)).cast("long").alias("least"),
        F.floor(_share(p, high_pct)).cast("long").alias("most"),
    )
    windows = F.flatten(F.collect_list(F.array("window", "least", "most")))
    last = F.when(F.count(F.lit(1)) >= n_positives, F.min("score"))
    ends = positives.groupBy("ask").agg(last.alias("low")).join(
        named.groupBy("ask").agg(windows.alias("windows"), F.min("least").alias("floor")), "ask"
    )
    ends = pin(ends)
    near = pin(
        visit(
            asks_with(ends.select("ask", "low", no_high.alias("high"), "windows")).filter("windows is not null"),
            between(books, None), n_negatives, False,
        )
    )
    # What a window still lacks may be as low as its floor; a full one asks for its last score.
    needed = (
        named.join(last_of(near, n_negatives), ["ask", "window"], "left")
        .groupBy("ask")
        .agg(F.min(F.coalesce("last", "least")).alias("needed"))
    )
    rest = ends.join(needed, "ask").filter("low is not null and needed <= low")
    far = visit(
        asks_with(rest.select("ask", F.col("needed").alias("low"), F.col("low").alias("high"), "windows")).filter(
            "windows is not null"
        ),
        between(books, None), n_negatives, False,
    )
    negatives = best(near.drop("rank").unionByName(far.drop("rank")), n_negatives)
    names = index.rows.filter(is_anchor).select(F.col("row").alias("ask"), F.col("vec_id").alias("anchor_id"))
    of_positives = positives.select(
        "ask", (F.col("rank") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return pin(
        negatives.join(of_positives, ["ask", "window"]).join(names, "ask").select(
            "anchor_id", "positive_id", F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )


def _share(score: Column, percent: int) -> Column:
    """`percent` hundredths of a whole score, without rounding."""
    return score.cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
