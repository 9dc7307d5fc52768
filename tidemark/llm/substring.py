"""Removal of word sequences that repeat, by fixed-block anchors.

A window of `width` words (35) that occurs twice holds, at either place, a whole block of half its width
(18) at a multiple of 18 of the document. So:

1. Anchors. Each chunk of documents asks with the hash of every rolling window of 18 words, marked where
   the window is a reference block, one of the non-overlapping ones. A hash is a hit if it is a block
   somewhere and occurs twice.
2. Extension. Hits are extended to all windows of 35 words around them, which are the candidates for
   maximal repeats; longer repeats are runs of them. Chunks ask with 96-bit hashes of the candidates.
3. Windows met twice anywhere, in the same document too, are removed, word by word, as judged on the input.

Hits only choose candidates, so a chance hit costs time, not correctness. A passage that thousands of
documents share is asked for once by each chunk: no key is hot and no pairs are made.

Null or empty text: no words, nothing removed. Texts shorter than a window stay. Repeated rows are copies of
each other and lose their windows. Empty table: no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm import chunks, common

WIDTH = 35
SECOND_BASE = 0xD6E8FEB86659FD93
KEPT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
)


class Chunk:
    """Words of a chunk's texts, one after another, as hashes."""

    def __init__(self, table: pa.Table) -> None:
        self.texts = [common.word_hashes(t.as_py()) for t in table.column("text")]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def windows(self, width: int, base: int = 0x9E3779B97F4A7C15) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows, and where each starts among the chunk's words."""
        hashes = [common.rolling(t, width, base) for t in self.texts]
        places = [np.arange(a, a + len(h)) for a, h in zip(self.starts, hashes)]
        return chunks.joined(hashes), chunks.joined(places, np.int64)

    def place_in_document(self, places: np.ndarray) -> np.ndarray:
        return places - self.starts[np.searchsorted(self.ends, places, side="right")]


def met_again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each stands first, and whether it stands more than once."""
    distinct, first, times = np.unique(keys, return_index=True, return_counts=True)
    return distinct, first, times > 1


def short(keys: np.ndarray) -> np.ndarray:
    """Keys with the leading 32 bits, which choose the part, and 16 more: enough to choose candidates."""
    return keys & np.uint64(0xFFFFFFFFFFFF0000)


def candidates(chunk: Chunk, hits: np.ndarray, block: int, width: int) -> np.ndarray:
    """Starts of windows of `width` words that hold a hit of `block` words."""
    keys, places = chunk.windows(block)
    total = int(chunk.ends[-1]) if len(chunk.ends) else 0
    count = np.zeros(total + 1, np.int64)
    count[places[np.isin(short(keys), hits)] + 1] = 1
    np.cumsum(count, out=count)
    _, starts = chunk.windows(width)
    return starts[count[starts + width - block + 1] > count[starts]]


def deduplicate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    chunk_chars: int = chunks.CHUNK_CHARS,
) -> DataFrame:
    """One row per document: n_words, n_removed and the kept words, joined by one space."""
    block = (width + 1) // 2
    texts, n_chunks = chunks.dealt(docs, id_col, text_col, chunk_chars)
    parts = max(1, math.ceil(n_chunks / 2))

    def anchors(table: pa.Table) -> list[dict]:
        chunk = Chunk(table)
        keys, places = chunk.windows(block)
        keys = short(keys)
        distinct, _, again = met_again(keys)
        blocks = np.unique(keys[chunk.place_in_document(places) % block == 0])
        flags = again.astype(np.uint8) | (np.isin(distinct, blocks).astype(np.uint8) << 1)
        return packed(table.column("chunk")[0].as_py(), distinct, flags)

    def packed(number: int, keys: np.ndarray, flags: np.ndarray) -> list[dict]:
        """As `chunks.asked`, with the six bytes of each key that are not zero."""
        rows = chunks.asked(number, 0, keys, parts, flags)
        for row in rows:
            row["keys"] = chunks.six_bytes(np.frombuffer(row["keys"], np.uint64))
        return rows

    def unpacked(table: pa.Table) -> list[np.ndarray]:
        return [chunks.from_six(raw) for raw in chunks.column(table, "keys", np.uint8)]

    def hit_anchors(table: pa.Table) -> list[dict]:
        keys, flags = unpacked(table), chunks.column(table, "data", np.uint8)
        distinct, where = np.unique(chunks.joined(keys), return_inverse=True)
        flat = chunks.joined(flags, np.uint8)
        times = np.bincount(where, minlength=len(distinct)) + np.bincount(where, weights=flat & 1, minlength=len(distinct))
        is_block = np.bincount(where, weights=flat >> 1, minlength=len(distinct)) > 0
        hit = ((times > 1) & is_block)[where]
        return replies(table, keys, hit)

    def replies(table: pa.Table, keys: list[np.ndarray], hit: np.ndarray) -> list[dict]:
        out, at = [], 0
        part = table.column("part")[0].as_py()
        for number, own in zip(table.column("chunk").to_pylist(), keys):
            good = own[hit[at : at + len(own)]]
            at += len(own)
            if len(good):
                out.append({"part": part, "chunk": number, "kind": 0, "keys": good.tobytes(), "data": b""})
        return out

    def extended(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return chunks.empty()
        chunk = Chunk(table)
        starts = candidates(chunk, chunks.joined(chunks.column(answers, "keys", np.uint64)), block, width)
        keys, places = chunk.windows(width)
        more, _ = chunk.windows(width, SECOND_BASE)
        chosen = np.isin(places, starts, assume_unique=True)
        distinct, first, again = met_again(keys[chosen])
        check = (more[chosen][first] >> np.uint64(32)).astype(np.uint32)
        number = table.column("chunk")[0].as_py()
        return chunks.table_of(chunks.asked(number, 0, distinct, parts, check, again.astype(np.uint8)))

    def repeated(table: pa.Table) -> list[dict]:
        keys = chunks.column(table, "keys", np.uint64)
        raw = chunks.column(table, "data", np.uint8)
        check = chunks.joined([d[: 4 * len(k)].copy().view(np.uint32) for k, d in zip(keys, raw)], np.uint32)
        again = chunks.joined([d[4 * len(k) :] for k, d in zip(keys, raw)], np.uint8)
        both = np.zeros(len(check), [("k", np.uint64), ("c", np.uint32)])
        both["k"], both["c"] = chunks.joined(keys), check
        order = np.lexsort((both["c"], both["k"]))
        ordered = both[order]
        new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        times = np.bincount(group) + np.bincount(group, weights=again[order])
        hit = np.zeros(len(both), bool)
        hit[order] = (times > 1)[group]
        return replies(table, keys, hit)

    def cleaned(table: pa.Table, answers: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in KEPT}
        if table.num_rows:
            chunk = Chunk(table)
            keys, places = chunk.windows(width)
            gone = places[np.isin(keys, chunks.joined(chunks.column(answers, "keys", np.uint64)))]
            edge = np.zeros((int(chunk.ends[-1]) if len(chunk.ends) else 0) + 1, np.int64)
            np.add.at(edge, gone, 1)
            np.add.at(edge, gone + width, -1)
            removed = np.cumsum(edge)[:-1] > 0
            out["doc_id"] = table.column("doc_id").to_pylist()
            for text, a, b in zip(table.column("text"), chunk.starts, chunk.ends):
                mask = removed[a:b]
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                n = int(mask.sum())
                if n:
                    words = [w for w, x in zip(words, mask.tolist()) if not x]
                out["n_words"].append(int(b - a))
                out["n_removed"].append(n)
                out["kept_text"].append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pa.Table.from_pydict(out, schema=KEPT)

    hits = chunks.answer(chunks.ask(texts, anchors), hit_anchors)
    windows = chunks.beside(texts, hits, extended, chunks.ASKED)
    again = chunks.answer(windows, repeated)
    return chunks.beside(texts, again, cleaned, "doc_id long, n_words long, n_removed long, kept_text string")
