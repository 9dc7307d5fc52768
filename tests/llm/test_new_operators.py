"""Nearest neighbours, hard negatives and fill-in-middle against plain versions, also on hard rows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import oracle_check as oc
from tests.conftest import rows
from tidemark.llm import fill_middle, hard_negatives, multi_index, neighbours, queries

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int, row long, a int, ask string, window int, rank int"
NAMES_THAT_CLASH = (1, 2, "x", 3, 4)


def vectors(spark, items):
    return spark.createDataFrame([(i, v, lab, *NAMES_THAT_CLASH) for i, v, lab in items], VECTORS)


def hard_vectors(seed=3, n=400, dim=7):
    """Clusters, a third of copies of one vector, repeated ids, ties and rows that take no part."""
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(9, dim))
    items = [(i, (centers[i % 9] + 0.3 * draw.normal(size=dim)).astype(np.float32).tolist(), int(draw.integers(4))) for i in range(n)]
    items += [(1000 + i, [0.5] * dim, i % 3) for i in range(n // 2)]
    items += [items[0], items[50], (50, [1.0] * dim, 1), (1000, [-0.5] * dim, 1)]
    items += [
        (2000, None, 1), (2050, [0.0] * dim, 1), (2100, [float("nan")] + [1.0] * (dim - 1), 1), (None, [1.0] * dim, 1),
        (2150, [None] + [1.0] * (dim - 1), 1), (2200, [float("inf")] + [1.0] * (dim - 1), 1), (2250, [], 2),
        (2300, [1.0] * (dim + 2), 2), (2400, [0.25] * dim, None),
    ]
    return items


def sound(items, dim, zero_too=False):
    return [
        (i, np.array(v, np.float32).astype(np.float64), lab)
        for i, v, lab in items
        if i is not None and v is not None and len(v) == dim and None not in v and np.isfinite(v).all() and (zero_too or any(v))
    ]


def plain_nearest(items, every, k, dim=7):
    known = sound(items, dim)
    out = []
    for j, (i, q, _) in enumerate(known):
        if i % every == 0:
            scored = [
                (-(q * x).sum() / np.sqrt((q * q).sum() * (x * x).sum()), other)
                for m, (other, x, _) in enumerate(known) if m != j
            ]
            out += [(i, r, other, -s) for r, (s, other) in enumerate(sorted(scored)[:k], 1)]
    return out


def plain_negatives(items, every, dim=7):
    known = [
        (i, np.floor(256 * v).astype(np.int64), lab)
        for i, v, lab in sound(items, dim, zero_too=True) if lab is not None
    ]
    out = []
    for j, (i, q, lab) in enumerate(known):
        if i % every == 0:
            scored = [(-int(q @ x), other, m) for m, (other, x, _) in enumerate(known) if m != j]
            same = sorted(s for s in scored if known[s[2]][2] == lab)[:5]
            for p, positive, _ in same:
                fit = sorted(s for s in scored if known[s[2]][2] != lab and -30 * p <= -100 * s[0] <= -90 * p)[:10]
                out += [(i, positive, r, other, -p, -s) for r, (s, other, _) in enumerate(fit, 1)]
    return sorted(out, key=str)


def test_heap_gives_all_pairs_by_rising_sum():
    draw = np.random.default_rng(1)
    for size in [(1, 1), (1, 6), (5, 1), (7, 9)]:
        a, b = draw.integers(0, 5, size[0]).astype(float), draw.normal(size=size[1])
        walked = list(multi_index.walk(a, b))
        assert sorted(p[1:] for p in walked) == [(i, j) for i in range(size[0]) for j in range(size[1])]
        costs = [c for c, _, _ in walked]
        assert costs == sorted(costs) and all(c == a[i] + b[j] for c, i, j in walked)


@pytest.mark.parametrize("block", [16, 2048])
def test_nearest_with_full_reach_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", block)
    monkeypatch.setattr(multi_index, "BLOCK_ASKS", block)
    items = hard_vectors()
    monkeypatch.setattr(neighbours, "cells_needed", lambda *_: 1 << 30)
    got = neighbours.nearest(vectors(spark, items), F.col("vec_id") % 50 == 0, k=5)
    want = plain_nearest(items, 50, 5)
    found = sorted(tuple(r) for r in got.collect())
    assert [r[:3] for r in found] == [r[:3] for r in sorted(want)]
    assert np.allclose([r[3] for r in found], [r[3] for r in sorted(want)], atol=1e-12)


def test_nearest_reaches_most_neighbours(spark):
    got = {}
    for r in queries.op11_nearest_neighbours(spark, FOLDER).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    table = [(r["vec_id"], r["embedding"], 0) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = plain_nearest(table, 50, 5, 64)
    assert sum(other in got[i] for i, _, other, _ in want) >= 0.9 * len(want)
    assert all(len(v) == 5 for v in got.values())


def test_copies_have_one_score_and_scale_does_not_matter(spark):
    q = np.random.default_rng(0).normal(size=33)
    x = np.array([q * 3.7e200, q * 1e-200, -q, q + 1, q + 1])
    scores = neighbours.cosine(q, x)
    assert scores[3] == scores[4] and np.allclose(scores[:3], [1, 1, -1], atol=1e-12)


def test_few_rows_give_all_candidates(spark):
    df = vectors(spark, [(0, [1.0, 0.0], 1), (1, [0.0, 2.0], 1), (2, [3.0, 0.0], 1)])
    got = neighbours.nearest(df, F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 2, 1.0), (0, 2, 1, 0.0)]
    lonely = neighbours.nearest(vectors(spark, [(0, [1.0], 1)]), F.lit(True))
    assert lonely.collect() == []


def test_empty_tables_give_no_rows(spark):
    empty = vectors(spark, [])
    nothing = vectors(spark, [(1, None, 1), (2, [], 1)])
    for df in (empty, nothing):
        assert neighbours.nearest(df, F.lit(True)).collect() == []
        assert hard_negatives.mine(df, F.lit(True)).collect() == []
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.transform(docs).collect() == []


@pytest.mark.parametrize("probe,block", [(1, 16), (100, 2048), (10_000, 64)])
def test_hard_negatives_are_exact(spark, monkeypatch, probe, block):
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", block)
    items = hard_vectors(seed=probe)
    got = hard_negatives.mine(vectors(spark, items), F.col("vec_id") % 50 == 0, probe_rows=probe)
    assert rows(got) == plain_negatives(items, 50)


def test_window_ends_are_exact(spark):
    # A positive of 256 * 256 * 1; 30 and 90 percent of 65536 are 19660.8 and 58982.4.
    line = [(0, 1.0, 1), (1, 1.0, 1), (2, 58982 / 65536, 2), (3, 58983 / 65536, 2), (4, 19661 / 65536, 2), (5, 19660 / 65536, 2)]
    df = vectors(spark, [(i, [v * 256.0, 0.0] if i > 1 else [1.0, 0.0], lab) for i, v, lab in line])
    got = hard_negatives.mine(df, F.col("vec_id") == 0, scale=256)
    items = [(i, [v * 256.0, 0.0] if i > 1 else [1.0, 0.0], lab) for i, v, lab in line]
    assert rows(got) == plain_negatives(items, 100, 2)[: got.count()]


def test_large_products_stay_whole():
    q, x = np.array([[2.0**30, 3.0]]), np.array([[2.0**30, 1.0], [1.0, 1.0]])
    assert hard_negatives.products(q, x).tolist() == [[2**60 + 3, 2**30 + 3]]


# ---- fill in middle ---------------------------------------------------------------------
UNITS = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def plain_form(doc_id, text):
    text = text or ""
    units = UNITS.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


HARD_TEXTS = [
    None, "", "a", "é", "\U0001f600", "ab cd", "a\nb\r\n\x00c", "<P>", "x<S>y", "<M", "<", "P><P", "<<P<S<M", "zZ[`{@aA",
    "é" * 50, "\U0001f600a" * 40, "word " * 30_000, "a" * 100_003, "中文" * 4_001, "\x7f\x80߿ࠀ￿",
]


def test_fill_in_middle_on_hard_texts(spark):
    docs = [(i + 40 * j, t) for j in range(12) for i, t in enumerate(HARD_TEXTS)] + [(None, "no id here"), (3, "é"), (3, "é")]
    df = spark.createDataFrame([(*d, 1, "c") for d in docs], "doc_id long, text string, n int, form string").repartition(3)
    got = fill_middle.transform(df)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    found = [tuple(r) for r in got.select("*", back).collect()]
    assert sorted((r[:-1] for r in found), key=repr) == sorted((plain_form(*d) for d in docs), key=repr)
    assert sorted(r[-1] for r in found) == sorted(t or "" for _, t in docs)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


TEXT = st.text(st.sampled_from(list("aZ[`{@ <P\n\x00\x7f\x80é߿ࠀ中￿\U0001f600\U0010ffff")), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=12), st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1))
def test_words_find_the_units(texts, x, y):
    encoded = [t.encode() for t in texts]
    ends = np.cumsum([len(e) for e in encoded])
    starts = ends - [len(e) for e in encoded]
    data = np.frombuffer(b"".join(encoded), np.uint8)
    draw = [np.full(len(texts), d, np.int64) for d in (x, y)]
    n, p, m, prefix, middle = fill_middle.cuts(data, starts, ends, *draw)
    for i, t in enumerate(texts):
        units = UNITS.findall(t)
        low, high = sorted((x % (len(units) + 1), y % (len(units) + 1)))
        head, body = "".join(units[:low]), "".join(units[low:high])
        assert n[i] == len(units)
        assert (p[i] - starts[i], m[i] - p[i]) == (len(head.encode()), len(body.encode()))
        assert (prefix[i], middle[i]) == (len(head), len(body))


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_fill_in_middle"])
def test_sql_agrees(spark, name):
    ok, note = oc.compare(spark, oc.connect(FOLDER), FOLDER, name)
    assert ok, note
