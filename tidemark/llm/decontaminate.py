"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Text and items are folded alike: A-Z to a-z, every ASCII character that is neither digit nor letter
to a space. The windows of 13 words of each item (the whole item if it has fewer words) become the
patterns of one automaton, and each text is scanned once. Hits are counted in words and mapped to
spans of code points of the original text.

Benchmarks are small beside a corpus. Their size is measured first: beyond `shard_bytes` of
patterns they are dealt to several automata, each of which scans the texts, and the findings of
all are united; no item is left out at any size.

Nulls, texts without words: no hits, not contaminated. Items without words: no window. Repeated
rows: each is judged and returned. Equal windows of several items count for all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

WINDOW = 13
SHARD_BYTES = 32 << 20
#: A text is contaminated if one word in so many is hit.
ONE_IN = 20

KEEP = b"0123456789abcdefghijklmnopqrstuvwxyz"
FOLD = bytes(
    c if c >= 0x80 or bytes([c]) in [KEEP[i : i + 1] for i in range(36)] else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

HITS = "n_words long, n_hit long, items array<string>, spans array<struct<start: long, end: long>>"


def folded(text: str | None) -> str:
    """The words, each followed and preceded by one space, as one character a byte."""
    joined = b" ".join((text or "").encode("utf-8", "surrogatepass").translate(FOLD).split())
    return f" {joined.decode('latin-1')} " if joined else ""


def windows_of(text: str | None, width: int = WINDOW) -> set[str]:
    words = folded(text).split(" ")[1:-1]
    if not words:
        return set()
    return {f" {' '.join(words[i : i + width])} " for i in range(max(1, len(words) - width + 1))}


def load_shards(benchmark: DataFrame, id_col: str, text_col: str, width: int, shard_bytes: int) -> list[dict]:
    """{window: ids of its items} in shards of about `shard_bytes`. Each item comes by one row at a time."""
    shards: list[dict[str, list[str]]] = [{}]
    size = 0
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t"))
    for item, text in rows.toLocalIterator():
        if size > shard_bytes:
            shards.append({})
            size = 0
        for window in windows_of(text, width):
            size += len(window)
            shards[-1].setdefault(window, []).append(item)
    return shards


def automaton_of(patterns: dict[str, list[str]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for pattern, items in patterns.items():
        found.add_word(pattern, (len(pattern), pattern.count(" ") - 1, tuple(items)))
    found.make_automaton()
    return found


def scan(automaton, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Words of the text, hit ranges of words (merged, end exclusive) and items of the hits."""
    line = folded(text)
    if not line:
        return 0, [], set()
    n_words = line.count(" ") - 1
    hits = list(automaton.iter(line))
    if not hits:
        return n_words, [], set()
    before = np.cumsum(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    ranges: list[tuple[int, int]] = []
    items: set[str] = set()
    for first, n, of in sorted((int(before[end - size + 1]) - 1, n, of) for end, (size, n, of) in hits):
        if ranges and first <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], max(ranges[-1][1], first + n))
        else:
            ranges.append((first, first + n))
        items.update(i for i in of if i is not None)
    return n_words, ranges, items


def original_spans(text: str, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Word ranges as code point spans of the text as it was."""
    if not ranges:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in ranges]


def scanner(patterns, key: str, schema: pa.Schema, keep_rows: bool):
    """For mapInArrow: findings of each row beside its id; with keep_rows, the clean rows as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = common.cached(("automaton", key), lambda: automaton_of(patterns.value))
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scanned = [scan(automaton, t) for t in texts]
            covered = [sum(b - a for a, b in r) for _, r, _ in scanned]
            if keep_rows:
                clean = [not (h > 0 and ONE_IN * h >= n) for h, (n, _, _) in zip(covered, scanned)]
                yield batch.filter(pa.array(clean, pa.bool_()))
                continue
            made = {
                "doc_id": batch.column("doc_id"),
                "n_words": [n for n, _, _ in scanned],
                "n_hit": covered,
                "items": [sorted(i) for _, _, i in scanned],
                "spans": [original_spans(t, r) if r else [] for t, (_, r, _) in zip(texts, scanned)],
            }
            yield pa.RecordBatch.from_arrays(
                [
                    made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], f.type)
                    for f in schema
                ],
                schema=schema,
            )

    return run


def _schema() -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_words", pa.int64()),
            ("n_hit", pa.int64()),
            ("items", pa.list_(pa.string())),
            ("spans", pa.list_(span)),
        ]
    )


def find_overlap(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per document: n_words, n_hit, the items met, the hit spans of the original text."""
    spark = docs.sparkSession
    shards = load_shards(benchmark, item_col, item_text_col, width, shard_bytes)
    rows = common.documents(docs, id_col, text_col)
    if len(shards) == 1:
        return _scanned(spark, rows, shards[0])
    return _united(spark, docs, rows, shards)


def _scanned(spark: SparkSession, rows: DataFrame, patterns: dict) -> DataFrame:
    shared = spark.sparkContext.broadcast(patterns)
    return rows.mapInArrow(scanner(shared, str(shared._jbroadcast.id()), _schema(), False), f"doc_id long, {HITS}")


def _united(spark: SparkSession, docs: DataFrame, rows: DataFrame, shards: list[dict]) -> DataFrame:
    """Findings of several automata, united by row; rows get a number that is fixed in the shared folder."""
    from tidemark.session import pin

    numbered = pin(rows.withColumn("row", F.monotonically_increasing_id()))
    parts = None
    for shard in shards:
        found = _scanned(spark, numbered.select(F.col("row").alias("doc_id"), "text"), shard)
        parts = found if parts is None else parts.unionByName(found)
    joined = parts.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
    )
    merged = joined.join(numbered.select(F.col("row").alias("doc_id"), "text", F.col("doc_id").alias("id")), "doc_id")

    def recount(batch: pa.RecordBatch) -> dict:
        out = {"doc_id": batch.column("id").to_pylist(), "n_words": batch.column("n_words").to_pylist()}
        out["items"] = batch.column("items").to_pylist()
        out["spans"], out["n_hit"] = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            united: list[dict] = []
            for s in spans:
                if united and s["start"] <= united[-1]["end"] + 1:
                    united[-1]["end"] = max(united[-1]["end"], s["end"])
                else:
                    united.append(dict(s))
            out["spans"].append(united)
            out["n_hit"].append(sum(len(WORD.findall(text[s["start"] : s["end"]])) for s in united))
        return out

    return merged.mapInArrow(common.per_batch(recount, _schema()), f"doc_id long, {HITS}")


def judged(found: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    spark = docs.sparkSession
    shards = load_shards(benchmark, "item_id", "text", WINDOW, shard_bytes)
    if len(shards) == 1:
        shared = spark.sparkContext.broadcast(shards[0])
        schema = pa.schema([])
        return docs.mapInArrow(scanner(shared, str(shared._jbroadcast.id()), schema, True), docs.schema)
    # Rows are told apart by a number, fixed in the shared folder, as ids may be missing or equal.
    number = "_row"
    while number in {c.lower() for c in docs.columns}:
        number += "_"
    rows = common.written(docs.withColumn(number, F.monotonically_increasing_id()))
    found = judged(find_overlap(rows, benchmark, id_col=number, shard_bytes=shard_bytes))
    bad = found.filter("contaminated").select(F.col("doc_id").alias(number))
    return rows.join(bad, number, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
