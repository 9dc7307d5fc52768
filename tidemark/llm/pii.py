r"""Personal data by a skip-chain conditional random field.

Four kinds of spans are found by rule: e-mail, IP address, card and phone. They stay as they are. Around
them a skip-chain CRF labels the words that hold a digit or an at sign. Words that stand next to each
other are linked by chain potentials; words that repeat, equal but for case and outer punctuation,
are linked, however distant, through one hub for each form, which keeps many repeats linear. Loopy
sum-product message passing makes their labels agree, and words that it labels beside the rule's
spans are reported too.

The potentials are learned from all documents in one counting pass: counts of word shapes by label, of
neighbouring labels and of agreement between repeats, summed by Spark, give softmax weights and
log-ratio potentials. Words inside rule spans keep their label.

Every scan is linear in the text, whatever it holds. Null or empty text has no spans; without any
shape counted nothing is added to the rules. Equal starts are ordered by kind. Repeated rows are
judged each.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

KINDS = ("email", "ip", "card", "phone")
LABELS = ("other", *KINDS)
ROUNDS = 6
MOST_AGREEMENT = 6.0
LEAST_FORM = 4

ANY = re.compile(r"[0-9@]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]")
OUTER = re.compile(r"^[^A-Za-z0-9+(]+|[^A-Za-z0-9)]+$")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, sought from each at sign backwards, so that long words are read once."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            floor = found.end()
        else:
            floor = max(floor, at + 1)
        at = text.find("@", floor)


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind from 1, end) of the rules' spans, in order."""
    found = [(a, 1, b) for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 2, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and passes_luhn(digits):
            found.append((m.start(), 3, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                found.append((m.start(), 4, m.end()))
    return sorted(found)


# Words of a document as the nodes of the field


def words_of(text: str) -> list[tuple[int, int, int]]:
    """(place among all words, start, end) of the words with a digit or an at sign, outer punctuation cut."""
    nodes = []
    for k, m in enumerate(WORD.finditer(text)):
        word = m[0]
        if ANY.search(word):
            left = OUTER.match(word)
            cut = left.end() if left and left.start() == 0 and left.end() < len(word) else 0
            size = len(word)
            while size > cut + 1 and not (word[size - 1].isalnum() or word[size - 1] == ")"):
                size -= 1
            nodes.append((k, m.start() + cut, m.start() + size))
    return nodes


def shape(word: str) -> int:
    """The features of a word as one number of bits."""
    digits = NOT_DIGIT.sub("", word)
    n = len(digits)
    bits = [
        "@" in word,
        bool(DOMAIN.search(word)),
        bool(IP.fullmatch(word)),
        word.count(".") >= 2,
        n == 0,
        1 <= n <= 3,
        4 <= n <= 6,
        7 <= n <= 9,
        10 <= n <= 13,
        14 <= n <= 19,
        n > 19,
        14 <= n <= 19 and passes_luhn(digits),
        word.startswith("+"),
        "(" in word or ")" in word,
        "-" in word,
        any(c.isalpha() for c in word),
    ]
    return sum(1 << i for i, b in enumerate(bits) if b)


FEATURES = 16


def form(word: str) -> str | None:
    """What repeats of a word have in common; short ones say too little."""
    plain = "".join(c for c in word.lower() if c.isalnum() or c == "@")
    return plain if len(plain) >= LEAST_FORM else None


def observed(nodes: list[tuple[int, int, int]], spans: list[tuple[int, int, int]]) -> list[int]:
    """The rule's label of each word; 0 if no span touches it."""
    labels = [0] * len(nodes)
    at = 0
    for start, no, end in spans:
        while at and nodes[at - 1][2] > start:
            at -= 1
        while at < len(nodes) and nodes[at][2] <= start:
            at += 1
        k = at
        while k < len(nodes) and nodes[k][1] < end:
            labels[k] = labels[k] or no
            k += 1
    return labels


def counts_of(text: str, tally: Counter) -> None:
    """Adds shapes by label, neighbouring labels, and agreement of repeats (some kind among them)."""
    nodes = words_of(text)
    labels = observed(nodes, base_spans(text))
    last: dict[str, int] = {}
    for i, ((k, a, b), label) in enumerate(zip(nodes, labels)):
        tally["shape", shape(text[a:b]), label] += 1
        if i and nodes[i - 1][0] == k - 1:
            tally["chain", labels[i - 1], label] += 1
        same = form(text[a:b])
        if same is not None:
            before = last.get(same)
            if before is not None and (before or label):
                tally["skip", 0, int(before == label)] += 1
            last[same] = label


# Learning


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, list]:
    """Weights from counts over all documents. The counts are few, whatever the number of documents."""

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if text and ANY.search(text):
                    counts_of(text, tally)
        if tally:
            what, a, b = zip(*tally)
            yield pa.RecordBatch.from_pydict(
                {"what": list(what), "a": list(a), "b": list(b), "n": list(tally.values())},
                schema=pa.schema([("what", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]),
            )

    rows = common.documents(docs, id_col, text_col).select("text").mapInArrow(tallied, "what string, a long, b long, n long")
    counted = rows.groupBy("what", "a", "b").agg(F.sum("n").alias("n")).orderBy("what", "a", "b").collect()
    return weights([tuple(r) for r in counted])


def bits_of(shapes: np.ndarray) -> np.ndarray:
    """One row of 0 and 1 for each shape, with a constant."""
    on = (shapes[:, None] >> np.arange(FEATURES)[None, :]) & 1
    return np.hstack([on, np.ones((len(shapes), 1))]).astype(float)


def weights(counted: list[tuple[str, int, int, int]], steps: int = 2000, rate: float = 0.5) -> dict[str, list]:
    """Softmax weights of shapes by gradient steps, log-ratio potentials of neighbours and repeats."""
    n = len(LABELS)
    shapes = sorted({a for what, a, _, _ in counted if what == "shape"})
    x = bits_of(np.array(shapes, np.int64)) if shapes else np.zeros((0, FEATURES + 1))
    y = np.zeros((len(shapes), n))
    pairs, agree = np.ones((n, n)), np.ones(2)
    for what, a, b, k in counted:
        if what == "shape":
            y[shapes.index(a), b] += k
        elif what == "chain":
            pairs[a, b] += k
        else:
            agree[b] += k
    w = np.zeros((FEATURES + 1, n))
    if len(shapes):
        # Rare shapes count less than their share of words would let them, common ones not above all.
        y = y / np.sqrt(y.sum(axis=1, keepdims=True))
        total = y.sum()
        for _ in range(steps):
            z = x @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            w += rate * (x.T @ (y - p * y.sum(axis=1, keepdims=True)) / total - 1e-4 * w)
    chain = np.log(pairs / pairs.sum(axis=1, keepdims=True) / (pairs.sum(axis=0) / pairs.sum()))
    skip = float(np.clip(np.log(agree[1] / agree[0]), 1.0, MOST_AGREEMENT))
    return {"unary": w.tolist(), "chain": np.clip(chain, -4, 4).tolist(), "skip": [skip]}


# Message passing


def normal(m: np.ndarray) -> np.ndarray:
    return m - np.logaddexp.reduce(m, axis=-1, keepdims=True)


def marginals(unary: np.ndarray, chain_pairs: np.ndarray, hub_of: np.ndarray, chain: np.ndarray, skip: float, rounds: int = ROUNDS) -> np.ndarray:
    """Log marginals of each word by loopy sum-product, all messages of a round at once.

    chain_pairs: rows (left, right) of neighbours. hub_of: the hub of each word, or -1.
    """
    n, k = unary.shape
    left, right = chain_pairs[:, 0], chain_pairs[:, 1]
    forward, backward = np.zeros((len(left), k)), np.zeros((len(left), k))
    tied = np.flatnonzero(hub_of >= 0)
    hubs = hub_of[tied]
    to_hub, from_hub = np.zeros((len(tied), k)), np.zeros((len(tied), k))
    same = np.where(np.eye(k, dtype=bool), skip, 0.0)
    n_hubs = int(hubs.max()) + 1 if len(tied) else 0

    def belief() -> np.ndarray:
        b = unary.copy()
        np.add.at(b, right, forward)
        np.add.at(b, left, backward)
        b[tied] += from_hub
        return b

    for _ in range(rounds):
        b = belief()
        new_forward = normal(np.logaddexp.reduce((b[left] - backward)[:, :, None] + chain[None], axis=1)) if len(left) else forward
        new_backward = normal(np.logaddexp.reduce((b[right] - forward)[:, None, :] + chain[None], axis=2)) if len(left) else backward
        if len(tied):
            to_hub = normal(np.logaddexp.reduce((b[tied] - from_hub)[:, :, None] + same[None], axis=1))
            total = np.zeros((n_hubs, k))
            np.add.at(total, hubs, to_hub)
            from_hub = normal(np.logaddexp.reduce((total[hubs] - to_hub)[:, :, None] + same[None], axis=1))
        forward, backward = new_forward, new_backward
    return normal(belief())


def extra_spans(text: str, spans: list[tuple[int, int, int]], model: dict[str, list]) -> list[tuple[int, int, int]]:
    """Spans that the field adds to those of the rules."""
    nodes = words_of(text)
    labels = observed(nodes, spans)
    if not any(label == 0 for label in labels):
        return []
    words = [text[a:b] for _, a, b in nodes]
    unary = bits_of(np.array([shape(w) for w in words], np.int64)) @ np.array(model["unary"])
    for i, label in enumerate(labels):
        if label:
            unary[i] = -50.0
            unary[i, label] = 0.0
    groups: dict[str, list[int]] = defaultdict(list)
    for i, w in enumerate(words):
        same = form(w)
        if same is not None:
            groups[same].append(i)
    hub_of = np.full(len(nodes), -1)
    for number, members in enumerate(m for m in groups.values() if len(m) > 1):
        hub_of[members] = number
    pairs = np.array([(i - 1, i) for i in range(1, len(nodes)) if nodes[i][0] == nodes[i - 1][0] + 1], int).reshape(-1, 2)
    said = marginals(normal(unary), pairs, hub_of, np.array(model["chain"]), model["skip"][0])
    best = said.argmax(axis=1)
    found: list[tuple[int, int, int]] = []
    last = None
    for i, (k, a, b) in enumerate(nodes):
        if labels[i] == 0 and best[i]:
            if last == (k - 1, best[i]):
                start, no, _ = found.pop()
                found.append((start, no, b))
            else:
                found.append((a, int(best[i]), b))
            last = (k, best[i])
    return found


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("base", pa.list_(pa.list_(pa.int64()))), ("spans", pa.list_(pa.list_(pa.int64())))]
)


def scan(docs: DataFrame, model: dict[str, list], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base and spans, arrays of [start, number of the kind from 1, end]."""
    usable = bool(model["unary"]) and any(any(r) for r in model["unary"])

    def judge(batch: pa.RecordBatch) -> dict:
        base, spans = [], []
        for text in batch.column("text").to_pylist():
            own = base_spans(text) if text and ANY.search(text) else []
            more = extra_spans(text, own, model) if usable and text and ANY.search(text) else []
            base.append([list(s) for s in own])
            spans.append([list(s) for s in sorted(own + more)])
        return {"doc_id": batch.column("doc_id").to_pylist(), "base": base, "spans": spans}

    rows = common.documents(docs, id_col, text_col)
    return rows.mapInArrow(
        common.per_batch(judge, SCHEMA), "doc_id long, base array<array<long>>, spans array<array<long>>"
    )


def listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, F.get(s, 1).cast("int")), F.get(s, 0), F.get(s, 2))), ","
    )


def number_of(spans: Column, no: int) -> Column:
    # A second parameter of the lambda, even one with a default, would be given the place in the array.
    return F.size(F.filter(spans, lambda s: F.get(s, 1) == no)).cast("long")


def digests(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id",
        *(number_of(F.col("base"), no).alias(f"n_{kind}") for no, kind in enumerate(KINDS, 1)),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
