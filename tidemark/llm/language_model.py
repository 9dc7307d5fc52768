"""A hierarchical Pitman-Yor model of word pairs, trained and applied to texts.

Each word is the context of a restaurant whose dishes are the words that follow it; all context
restaurants share one parent, whose base is uniform over the vocabulary and one unknown word. The
customers of the parent are the tables of its children.

First a seating is drawn from a formula in place of a state: the unigram base as the parent's prediction,
seen**0.8 as the tables of a restaurant. Then come `SWEEPS` Gibbs sweeps over blocks: of each dish of each
restaurant the customers are seated anew, given the parent's predictive probability and the tables of
the restaurant in the seating drawn before; then the parent's, given their new tables and the parent's
tables drawn before. All dishes of a sweep are drawn side by side, so each still meets its own old tables
in the totals. Late customers of a dish are seated in groups, of whom a binomial number opens tables.
`CHAINS` chains run side by side, and texts are scored by the mean of their predictive probabilities. A
draw depends on the dish, the chain and the sweep only, so every task that needs a seating draws the
same one, and a task that runs again repeats it.

All counts are over all training documents. Each text is split and hashed once: a chunk of texts becomes packed
rows, one for each part of the pairs, that hold its distinct pairs, how often training texts have them, and in which of
its texts they stand. By part these rows become one table of pairs, each once, with its count; all seatings are
drawn on that table, and words are summed up by an exchange of packed rows (see `chunks`). The same rows, shuffled
once, then give each text's sum over its pairs. Parts are the fields of a grid: the context's hash gives a pair's row,
the dish's hash its column. So a part names the words of one row and one column only, not of all pairs, while the
pairs of a frequent word are spread over all parts of its row and column.

Null text is empty: its only token is the end. Rows without an id are trained on. Repeated rows count
each. Without training texts every token has the base probability. Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import chunks, common
from tidemark.llm.neardup import folded

CHAINS = 2
#: Reseatings after the first seating.
SWEEPS = 2
#: Discount and strength of the context restaurants and of their parent.
DISCOUNT, STRENGTH = 0.8, 2.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.6, 10.0
CHUNK_CHARS = 10_000_000
#: Words are told apart by 56 bits of their hash: the byte left out is shuffled with every word.
WORD_BITS = np.uint64(0xFFFFFFFFFFFFFF00)
START, END = np.uint64(0x243F6A8885A30800), np.uint64(0x13198A2E03707300)
#: Sums of logarithms are whole numbers of this part, so that no order of parts changes them.
UNIT = 2.0**32
PAIR_BASE = np.uint64(0xA0761D6478BD642F)
#: Chunks whose pairs make a part.
CHUNKS_PER_PART = 3
#: Kinds of rows, and the numbers of totals (less the chain, and 1000 for each sweep before).
WORDS, PAIRS, STATE, DOCS = 0, 1, 2, 9
TOKENS, DISTINCT, TABLES, CUSTOMERS = -1, -2, -10, -20
SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("trained", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)


def log_factorial(n: np.ndarray) -> np.ndarray:
    """By Stirling's series, from 8 numbers further on."""
    x = n + 9
    ahead = np.log(np.multiply.reduce([n + k for k in range(1, 9)]))
    return (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) - ahead


def binomial(n: np.ndarray, share: np.ndarray, luck: np.ndarray) -> np.ndarray:
    """Binomial numbers by inversion of `luck`, outward from the mode: steps grow with the deviation only."""
    share = np.clip(share, 1e-300, 1 - 1e-16)
    odds = share / (1 - share)
    mode = np.minimum(np.floor((n + 1) * share), n)
    logs = log_factorial(n) - log_factorial(mode) - log_factorial(n - mode)
    top = np.exp(logs + mode * np.log(share) + (n - mode) * np.log1p(-share))
    out, left = mode.copy(), luck - top
    ends = [[mode.copy(), top.copy()], [mode.copy(), top.copy()]]
    live = np.flatnonzero(left >= 0)
    while len(live):
        for up, (at, chance) in zip((True, False), ends):
            k = at[live]
            chance[live] *= (n[live] - k) / (k + 1) * odds[live] if up else k / ((n[live] - k + 1) * odds[live])
            at[live] += 1 if up else -1
            left[live] -= chance[live]
            hit = left[live] < 0
            out[live[hit]] = at[live[hit]]
            live = live[~hit]
        live = live[np.maximum(ends[0][1][live], ends[1][1][live]) > 1e-18]  # else rounding left some luck over
    return out


def tables_drawn(customers: np.ndarray, weight: np.ndarray, discount: float, keys: np.ndarray, chain: int) -> np.ndarray:
    """Tables of each dish with so many customers, the next of whom opens one by `weight` against the seated."""
    tables = (customers > 0).astype(np.float64)
    seated = tables.copy()
    live = np.flatnonzero(customers > 1)
    turn = 0
    while len(live):
        turn += 1
        group = np.minimum(np.maximum(1, np.floor(seated[live] / 8)), customers[live] - seated[live])
        against = seated[live] - discount * tables[live]
        share = weight[live] / (weight[live] + against)
        # For a group as it is at its middle, as the share falls on the way.
        share = weight[live] / (weight[live] + against + (group - 1) / 2 * (1 - discount * share))
        luck = common.mixed(keys[live] + np.uint64((chain * 1_000_003 + turn * 7_919) & common.MASK))
        luck = luck / 2.0**64
        opened = (luck < share).astype(np.float64)
        many = np.flatnonzero(group > 1)
        opened[many] = binomial(group[many], share[many], luck[many])
        tables[live] += opened
        seated[live] += group
        live = live[seated[live] < customers[live]]
    return tables


def few_distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and where each value stands among them; only the distinct ones are sorted."""
    import pandas as pd

    codes, found = pd.factorize(values)
    order = np.argsort(found)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return found[order], place[codes]


def planes(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte and compressed: high bytes are mostly equal."""
    wide = np.ascontiguousarray(values)
    return chunks.small(wide.view(np.uint8).reshape(-1, wide.itemsize).T)


def from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(chunks.large(data, np.uint8).reshape(size, -1).T).view(kind).reshape(-1)


def several(*packed: bytes) -> bytes:
    """Byte strings as one, with their lengths ahead."""
    return np.array([len(packed), *map(len, packed)], np.int64).tobytes() + b"".join(packed)


def apart(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    ends = np.cumsum([8 * (n + 1), *np.frombuffer(data, np.int64, n, 8)])
    return [data[x:y] for x, y in zip(ends, ends[1:])]


def grid_of(parts: int) -> tuple[int, int]:
    """Rows and columns of a grid with so many fields or a few more."""
    rows = max(1, math.isqrt(parts))  # an empty table has one field
    return rows, max(1, math.ceil(parts / rows))


def grouped(words: np.ndarray, groups: int) -> np.ndarray:
    """The group of each word, by its hash."""
    return ((common.mixed(words) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def packed_chunk(number: int, rows: pa.Table, grid: tuple[int, int]) -> list[dict]:
    """A chunk of texts as rows: the documents, and for each part the pairs that stand in them."""
    hashed = [common.word_hashes(folded(t.as_py()) if t.is_valid else None) for t in rows.column("text")]
    sizes = np.array([len(h) + 1 for h in hashed], np.int64)
    trained = np.array(rows.column("trained").to_pylist(), bool)
    words, at = few_distinct(np.concatenate([x for h in hashed for x in (h & WORD_BITS, [END])] + [[START]]).astype(np.uint64))
    del hashed
    dish, start = at[:-1], at[-1]
    context = np.empty_like(dish)
    context[1:] = dish[:-1]
    context[np.cumsum(sizes) - sizes] = start
    n_words, n_docs = len(words), len(sizes)
    code = (context * n_words + dish) * n_docs + np.repeat(np.arange(n_docs), sizes)
    code, times = np.unique(code, return_counts=True)
    pair, doc = np.divmod(code, n_docs)
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    per_pair = np.diff(first, append=len(pair))
    context, dish = np.divmod(pair[first], n_words)
    learned = np.add.reduceat(times * trained[doc], first)
    part = grouped(words, grid[0])[context] * grid[1] + grouped(words, grid[1])[dish]
    of_entry = np.repeat(part, per_pair)
    ids = [i.as_py() for i in rows.column("doc_id")]
    known = np.array([i is not None for i in ids])
    listed = several(
        planes(np.array([i or 0 for i in ids], np.int64)), planes(known), planes(trained), planes(sizes.astype(np.uint32))
    )
    out = [{"part": number % math.prod(grid), "chunk": number, "kind": DOCS, "keys": b"", "data": listed}]
    for p in np.unique(part):
        mine, entries = part == p, of_entry == p
        used, place = few_distinct(np.concatenate([context[mine], dish[mine]]))
        half = len(place) // 2
        data = several(
            planes(place[:half].astype(np.uint32)), planes(place[half:].astype(np.uint32)),
            planes(learned[mine].astype(np.uint32)), planes(per_pair[mine].astype(np.uint32)),
            planes(doc[entries].astype(np.uint32)), planes(times[entries].astype(np.uint32)),
        )
        steps = np.diff(words[used], prepend=np.uint64(0))
        out.append({"part": int(p), "chunk": number, "kind": PAIRS, "keys": planes(steps), "data": data})
    return out


def packed(grid: tuple[int, int], chunk_chars: int):
    """A function for mapInArrow: texts gathered to chunks, and each chunk packed."""

    def run(batches):
        from pyspark import TaskContext

        number, held, chars = (TaskContext.get().partitionId() << 32) - 1, [], 0
        for batch in batches:
            lengths = np.array([len(t.as_buffer() or b"") + 1 if t.is_valid else 1 for t in batch.column("text")])
            begin = 0
            while begin < len(lengths):
                # As many rows as fill the chunk, one at least.
                room = np.searchsorted(np.cumsum(lengths[begin:]), max(chunk_chars - chars, 1)) + 1
                piece = batch.slice(begin, int(room))
                held.append(piece)
                chars += int(lengths[begin : begin + len(piece)].sum())
                begin += len(piece)
                if chars >= chunk_chars:
                    number += 1
                    yield from chunks.table_of(packed_chunk(number, pa.Table.from_batches(held), grid)).to_batches()
                    held, chars = [], 0
        if held:
            yield from chunks.table_of(packed_chunk(number + 1, pa.Table.from_batches(held), grid)).to_batches()

    return run


def pair_keys(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return common.mixed(before * PAIR_BASE + words)


class Packed:
    """The pairs of one chunk in one part, and the texts they stand in."""

    def __init__(self, row: dict) -> None:
        self.words = np.cumsum(from_planes(row["keys"], np.uint64), dtype=np.uint64)
        data = apart(row["data"])
        self.at_context, self.at_dish, self.learned, self.per_pair = (from_planes(d, np.uint32) for d in data[:4])
        self.entries = data[4:]
        self.chunk = row["chunk"]

    def keys(self) -> np.ndarray:
        return pair_keys(self.words[self.at_context], self.words[self.at_dish])

    def sums(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with pairs here, and for each row of `values` by pair its sum over a text's pairs."""
        doc, times = (from_planes(d, np.uint32) for d in self.entries)
        each = np.repeat(values, self.per_pair, axis=1) * times
        there, place = few_distinct(doc)
        return there, np.array([np.bincount(place, weights=v, minlength=len(there)) for v in each])


class Pairs:
    """The distinct pairs of a part and their words."""

    def __init__(self, keys: np.ndarray, context: np.ndarray, dish: np.ndarray, counts: np.ndarray) -> None:
        self.pairs, self.counts = keys, counts
        self.words, place = few_distinct(np.concatenate([np.where(context == START, END, context), dish]))
        # A start is seated as often as an end, so the end's counts serve for it.
        self.context, self.dish = place[: len(keys)], place[len(keys) :]

    @staticmethod
    def read(table: pa.Table) -> Pairs:
        row = table.to_pylist()[0]
        words = np.cumsum(from_planes(row["keys"], np.uint64), dtype=np.uint64)
        context, dish, counts = (from_planes(d, np.uint32) for d in apart(row["data"]))
        context, dish = words[context], words[dish]
        return Pairs(pair_keys(context, dish), context, dish, counts.astype(np.float64))


def packed_rows(table: pa.Table) -> list[Packed]:
    return [Packed(r) for r in table.filter(pa.compute.equal(table.column("kind"), PAIRS)).to_pylist()]


def distinct(rows: list[Packed]) -> tuple[tuple[np.ndarray, ...], list[np.ndarray]]:
    """Keys, contexts, dishes and counts of all pairs of the chunks' rows, each once; which of them each row's are."""
    keys, first, which = np.unique(np.concatenate([r.keys() for r in rows]), return_index=True, return_inverse=True)
    which = which.astype(np.int32)
    counts = np.zeros(len(keys))
    context, dish = np.empty(len(keys), np.uint64), np.empty(len(keys), np.uint64)
    mine, begin = [], 0
    for r in rows:
        end = begin + len(r.at_context)
        # The words of a pair come from the first row that has it.
        at = np.flatnonzero((first >= begin) & (first < end))
        context[at] = r.words[r.at_context[first[at] - begin]]
        dish[at] = r.words[r.at_dish[first[at] - begin]]
        mine.append(which[begin:end])
        counts[mine[-1]] += r.learned  # a row has each pair once
        begin = end
    return (keys, context, dish, counts), mine


def merged(table: pa.Table) -> list[dict]:
    """The pairs of a part as one row, under the part's number: words, and places of contexts and dishes among them."""
    rows = packed_rows(table)
    if not rows:
        return []
    (_, context, dish, counts), _ = distinct(rows)
    del rows
    words, place = few_distinct(np.concatenate([context, dish]))
    order = np.lexsort((place[len(context) :], place[: len(context)]))
    data = several(
        planes(place[: len(context)][order].astype(np.uint32)),
        planes(place[len(context) :][order].astype(np.uint32)),
        planes(counts[order].astype(np.uint32)),
    )
    part = table.column("part")[0].as_py()
    steps = np.diff(words, prepend=np.uint64(0))
    return [{"part": part, "chunk": part, "kind": PAIRS, "keys": planes(steps), "data": data}]


def asked(number: int, kind: int, keys: np.ndarray, parts: int, columns: np.ndarray, head: bytes = b"") -> list[dict]:
    """A question about words, with columns of small counts behind a head."""
    rows = chunks.asked(number, kind, keys, parts, np.arange(len(keys), dtype=np.int64))
    for row in rows:
        where = np.frombuffer(row["data"], np.int64)
        row["data"] = head + planes(columns[:, where[0] : where[-1] + 1].astype(np.uint32).reshape(-1))
        # Only the first question names the words; later ones are about the same, in the same order.
        steps = np.diff(np.frombuffer(row["keys"], np.uint64), prepend=np.uint64(0))
        row["keys"] = planes(steps) if kind == WORDS else b""
    return rows


class Asked:
    """All questions of a kind to a part: distinct keys, and which of them each asked key is."""

    def __init__(self, table: pa.Table, kind: int, head: int = 0, named: pa.Table | None = None) -> None:
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        names = {r["chunk"]: r["keys"] for r in (table if named is None else named).to_pylist()}
        self.part = table.column("part")[0].as_py()
        self.kind = kind
        self.numbers = [r["chunk"] for r in rows]
        keys = [np.cumsum(from_planes(names[r["chunk"]], np.uint64), dtype=np.uint64) for r in rows]
        self.sizes = [len(k) for k in keys]
        self.head = rows[0]["data"][:head] if rows else bytes(head)
        data = [from_planes(r["data"][head:], np.uint32).reshape(-1, len(k)) for r, k in zip(rows, keys)]
        self.data = np.concatenate(data, axis=1) if data else np.zeros((1, 0), np.uint32)
        self.keys, self.which = np.unique(chunks.joined(keys), return_inverse=True)
        self.totals = np.array([np.bincount(self.which, weights=c, minlength=len(self.keys)) for c in self.data])

    def told(self, values: np.ndarray) -> list[dict]:
        """Each chunk's columns of values, given for each asked key, in the order of its own keys."""
        out, at = [], 0
        for number, size in zip(self.numbers, self.sizes):
            data = planes(values[:, at : at + size].astype(np.uint32).reshape(-1))
            out.append({"part": self.part, "chunk": number, "kind": self.kind, "keys": b"", "data": data})
            at += size
        return out


class Answers:
    """What a chunk was told, by kind; columns are in the order of the sorted keys it asked for."""

    def __init__(self, table: pa.Table) -> None:
        self.parts: dict[int, list[tuple[int, bytes]]] = {}
        self.totals: dict[int, int] = {}
        for r in table.to_pylist():
            if r["kind"] == -1:
                self.totals[int(r["keys"])] = r["part"]
            else:
                self.parts.setdefault(r["kind"], []).append((r["part"], r["data"]))

    def columns(self, kind: int, n: int) -> np.ndarray:
        told = [from_planes(d, np.uint32).reshape(n, -1) for _, d in sorted(self.parts.get(kind, []))]
        return np.concatenate(told, axis=1).astype(float) if told else np.zeros((n, 0))


def total_row(number: int, value: float) -> dict:
    """A part's share of a total over all words, under a negative chunk number."""
    return {"part": int(value), "chunk": number, "kind": -1, "keys": b"", "data": b""}


def score(
    docs: DataFrame,
    trained: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    chains: int = CHAINS,
    sweeps: int = SWEEPS,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row per document: counts, the base score and the model's log10 probability.

    Documents for which `trained` holds are learned from; all are scored. After the first seating come `sweeps` more.
    """
    flag = F.coalesce(trained, F.lit(True)).alias("trained")
    texts = common.documents(docs, id_col, text_col, flag)
    chars = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1)).first()[0] or 0
    grid = grid_of(math.ceil(chars / chunk_chars / CHUNKS_PER_PART))
    parts = math.prod(grid)

    def ask_counts(table: pa.Table) -> list[dict]:
        t = Pairs.read(table)
        counts = np.bincount(t.dish, weights=t.counts, minlength=len(t.words))[None]
        return asked(table.column("chunk")[0].as_py(), WORDS, t.words, parts, counts)

    def count(table: pa.Table) -> list[dict]:
        """How often training texts have each word."""
        words = Asked(table, WORDS)
        rows = words.told(words.totals[:, words.which])
        return [*rows, total_row(TOKENS, words.totals.sum()), total_row(DISTINCT, (words.totals > 0).sum())]

    def base(seen: np.ndarray, totals: dict[int, int]) -> np.ndarray:
        return (seen + 0.5) / (totals.get(TOKENS, 0) + 0.5 * (totals.get(DISTINCT, 0) + 1))

    def parent(state: np.ndarray, totals: dict[int, int], k: int) -> np.ndarray:
        """The parent's predictive probability of each word in chain k."""
        customers, own = state[chains + k], state[2 * chains + k]
        all_customers, all_tables = totals.get(CUSTOMERS - k, 0), totals.get(TABLES - k, 0)
        spare = (PARENT_STRENGTH + PARENT_DISCOUNT * all_tables) / (PARENT_STRENGTH + all_customers)
        backed = spare / (totals.get(DISTINCT, 0) + 1)
        return np.maximum(customers - PARENT_DISCOUNT * own, 0) / (PARENT_STRENGTH + all_customers) + backed

    def drawn(t: Pairs, told: Answers, k: int, sweep: int) -> np.ndarray:
        """Tables of the part's pairs in chain k and a sweep, given the state that the sweep before left."""
        if sweep:
            state = told.columns(STATE + sweep - 1, 3 * chains)
            prior, opened = parent(state, {**told.totals, **sweep_totals(told, sweep - 1)}, k), state[k]
        else:
            seen = told.columns(WORDS, 1)[0]
            prior, opened = base(seen, told.totals), seen**0.8
        weight = (STRENGTH + DISCOUNT * opened[t.context]) * prior[t.dish]
        return tables_drawn(t.counts, weight, DISCOUNT, t.pairs, k + chains * sweep)

    def sweep_totals(told: Answers, sweep: int) -> dict[int, int]:
        at = 1000 * sweep
        return {k: told.totals.get(k - at, 0) for c in range(chains) for k in (TABLES - c, CUSTOMERS - c)}

    def parent_weights(told: Answers, sweep: int) -> bytes:
        """By which a customer of the parent opens a table, in each chain, by the parent's tables drawn before."""
        before = sweep_totals(told, sweep - 1) if sweep else {}
        tables = np.array([before.get(TABLES - k, 0) for k in range(chains)], np.float64)
        return ((PARENT_STRENGTH + PARENT_DISCOUNT * tables) / (told.totals.get(DISTINCT, 0) + 1)).tobytes()

    def seat(sweep: int):
        def run(table: pa.Table, answers: pa.Table) -> pa.Table:
            if not table.num_rows:
                return chunks.empty()
            t, told = Pairs.read(table), Answers(answers)
            own = [drawn(t, told, k, sweep) for k in range(chains)]
            sums = [np.bincount(by, weights=w, minlength=len(t.words)) for by in (t.context, t.dish) for w in own]
            number = table.column("chunk")[0].as_py()
            return chunks.table_of(asked(number, STATE + sweep, t.words, parts, np.array(sums), parent_weights(told, sweep)))

        return run

    def seat_parent(sweep: int):
        def run(table: pa.Table, named: pa.Table) -> pa.Table:
            if not table.num_rows:
                return chunks.empty()
            words = Asked(table, STATE + sweep, 8 * chains, named)
            weights = np.frombuffer(words.head, np.float64)
            own = [
                tables_drawn(
                    words.totals[chains + k],
                    np.full(len(words.keys), weights[k]),
                    PARENT_DISCOUNT,
                    words.keys,
                    k + chains * sweep,
                )
                for k in range(chains)
            ]
            rows = words.told(np.vstack([words.totals, *own])[:, words.which])
            for k in range(chains):
                rows.append(total_row(TABLES - k - 1000 * sweep, own[k].sum()))
                rows.append(total_row(CUSTOMERS - k - 1000 * sweep, words.totals[chains + k].sum()))
            return chunks.table_of(rows)

        return run

    def with_totals(answers: DataFrame) -> DataFrame:
        return answers.filter("chunk >= 0").union(chunks.to_all(answers, parts))

    # Exchanges that several steps read have one form each, so that Spark makes them once.
    rows = texts.mapInArrow(packed(grid, chunk_chars), chunks.ASKED)
    table = rows.groupBy("part").applyInArrow(lambda t: chunks.table_of(merged(t)), chunks.ASKED).repartition("chunk")
    questions = chunks.ask(table, ask_counts)
    counts = known = with_totals(chunks.answer(questions, count).repartition("chunk"))
    for sweep in range(sweeps + 1):
        states = chunks.beside(table, known, seat(sweep), chunks.ASKED)
        replies = states.groupBy("part").cogroup(questions.groupBy("part")).applyInArrow(seat_parent(sweep), chunks.ASKED)
        state = with_totals(replies.repartition("chunk"))
        # A seating is drawn from the one before it; the last is drawn again where texts are scored.
        last = known if sweep == sweeps else counts
        known = last.union(state)

    def summed(table: pa.Table, answers: pa.Table) -> pa.Table:
        """For each chunk and each of its texts the sums over the pairs of this part."""
        if not table.num_rows:
            return chunks.empty()
        listed = table.filter(pa.compute.equal(table.column("kind"), DOCS)).to_pylist()
        of_chunks = packed_rows(table)
        if not of_chunks:
            return chunks.table_of(listed)
        found, which = distinct(of_chunks)
        t, told = Pairs(*found), Answers(answers)
        del found
        seen = told.columns(WORDS, 1)[0]
        state = told.columns(STATE + sweeps, 3 * chains)
        totals = {**told.totals, **sweep_totals(told, sweeps)}
        guests = seen[t.context]
        mean = np.zeros(len(t.pairs))
        for k in range(chains):
            # The tables are those that the last state sums up, so that probabilities add up to one.
            tables = drawn(t, told, k, sweeps)
            prior = parent(state, totals, k)[t.dish]
            own = np.maximum(t.counts - DISCOUNT * tables, 0) + (STRENGTH + DISCOUNT * state[k][t.context]) * prior
            mean += np.where(guests > 0, own / (STRENGTH + guests), prior) / chains
            del tables, prior, own
        values = np.array(
            [np.ones(len(mean)), (seen > 0)[t.dish], np.log10(base(seen, told.totals))[t.dish], np.log10(mean)]
        )
        number, total = table.column("part")[0].as_py(), told.totals.get(TOKENS, 0)
        for row, mine in zip(of_chunks, which):
            docs, sums = row.sums(values[:, mine])
            data = several(
                planes(np.diff(docs.astype(np.uint32), prepend=np.uint32(0))), planes(sums[:2].astype(np.uint32).reshape(-1)),
                planes(np.round(sums[2:] * UNIT).astype(np.int64).reshape(-1)), np.int64(total).tobytes(),
            )
            listed.append({"part": number, "chunk": row.chunk, "kind": PAIRS, "keys": b"", "data": data})
        return chunks.table_of(listed)

    def finished(table: pa.Table) -> pa.Table:
        """The documents of a chunk with their sums over all parts."""
        found = sorted(table.to_pylist(), key=lambda r: (r["kind"] != DOCS, r["part"]))
        ids, known_id, flags, sizes = (
            from_planes(d, k) for d, k in zip(apart(found[0]["data"]), (np.int64, bool, bool, np.uint32))
        )
        sums, total = np.zeros((4, len(ids)), np.int64), 0
        for r in found[1:]:
            docs, numbers, values, tokens = apart(r["data"])
            docs = np.cumsum(from_planes(docs, np.uint32))
            sums[:2, docs] += from_planes(numbers, np.uint32).reshape(2, -1)
            sums[2:, docs] += from_planes(values, np.int64).reshape(2, -1)
            total = int(np.frombuffer(tokens, np.int64)[0])
        if (sums[0] != sizes).any():
            raise RuntimeError("a chunk of texts was read in another order when a lost task ran again")
        return pa.Table.from_arrays(
            [
                pa.array(ids, mask=~known_id), pa.array(flags), pa.array(sizes.astype(np.int64)),
                pa.array(sums[1]), pa.array(np.full(len(ids), total)), pa.array(sums[2] / UNIT), pa.array(sums[3] / UNIT),
            ],
            schema=SCORED,
        )

    sums = rows.groupBy("part").cogroup(known.groupBy("chunk")).applyInArrow(summed, chunks.ASKED)
    return sums.groupBy("chunk").applyInArrow(
        finished,
        "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
