"""Fill-in-middle transformation: two cuts at unit ends, then prefix, suffix and middle in a new order.

A unit is a run of ASCII letters or one other code point. Units are never listed: the texts of a batch
are one buffer of UTF-8, viewed as 64-bit words of eight bytes. Arithmetic on whole words sets the high
bit of each byte that ends a unit, `bitwise_count` counts them per word, and a running sum over the words
finds the word of the k-th end by binary search; a byte-wise prefix sum inside that word selects the byte.
So a cut costs a search, whatever the length of the text, and no Python object is made per unit.

Each row is worked on alone: nothing is shuffled, and repeated rows, ties and hot sources change nothing.
Null texts are empty; empty texts, and texts that hold a marker, stay as they are (form plain). A null id
draws its cuts from an empty string. Columns other than the id and the text are left behind, so their names
cannot clash; an empty table gives no rows. Memory is a few times the text of one Arrow batch.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20

HIGH, LOW = np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)
_TO_LOWER, _SEVEN = np.uint64(0x2020202020202020), np.uint64(0x7F7F7F7F7F7F7F7F)
_FROM_A, _BEYOND_Z = np.uint64(0x1F1F1F1F1F1F1F1F), np.uint64(0x0505050505050505)

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()), ("prefix", pa.large_binary()), ("middle", pa.large_binary()),
        ("suffix", pa.large_binary()),
    ]
)
COLUMNS = (
    "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
    "prefix binary, middle binary, suffix binary"
)


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, zeros after the end."""
    padded = np.zeros(-(-len(data) // 8) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def letters(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is an ASCII letter; no sum carries into the next byte."""
    low = (words | _TO_LOWER) & _SEVEN
    return (low + _FROM_A) & ~(low + _BEYOND_Z) & ~words & HIGH


def continued(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte 10xxxxxx, which goes on with a code point."""
    return words & ~(words << np.uint64(1)) & HIGH


def following(marks: np.ndarray) -> np.ndarray:
    """For each byte the mark of the byte after it, across words."""
    out = marks >> np.uint64(8)
    out[:-1] |= marks[1:] << np.uint64(56)
    return out


class Marks:
    """Marked bytes of a buffer, with counts up to a place and the place of the k-th mark."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(np.bitwise_count(marks), out=self.upto[1:])

    def before(self, place: np.ndarray) -> np.ndarray:
        """Marks on the bytes before each place."""
        word, inside = place >> 3, (place & 7).astype(np.uint64)
        mask = (np.uint64(1) << (inside * np.uint64(8))) - np.uint64(1)
        part = np.append(self.marks, np.uint64(0))[word] & mask
        return self.upto[word] + np.bitwise_count(part)

    def behind(self, k: np.ndarray) -> np.ndarray:
        """The place right after the k-th mark, from 1; k must be there."""
        word = np.searchsorted(self.upto, k, side="left") - 1
        rank = (k - self.upto[word]).astype(np.uint64)
        sums = (self.marks[word] >> np.uint64(7)) * LOW
        # A byte of `sums` is at most 8, so with its high bit set no subtraction borrows from the next.
        reached = ((sums | HIGH) - rank * LOW) & HIGH
        return word * 8 + (8 - np.bitwise_count(reached).astype(np.int64)) + 1


def cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, draw_a: np.ndarray, draw_b: np.ndarray):
    """Units of each text and the places (bytes), with code points before them, of its two cuts."""
    words = words_of(data)
    letter, rest = letters(words), continued(words)
    unit_ends = ~following(rest) & ~(letter & following(letter)) & HIGH
    # Neighbours in the buffer are different texts: the last byte of each ends a unit.
    last = ends[ends > starts] - 1
    np.bitwise_or.at(unit_ends, last >> 3, np.uint64(0x80) << ((last & 7).astype(np.uint64) * np.uint64(8)))
    units, points = Marks(unit_ends), Marks(~rest & HIGH)
    base = units.before(starts)
    n = units.before(ends) - base
    first, second = draw_a % (n + 1), draw_b % (n + 1)
    low, high = np.minimum(first, second), np.maximum(first, second)

    def place(units_kept: np.ndarray) -> np.ndarray:
        out = starts.copy()
        some = units_kept > 0
        out[some] = units.behind((base + units_kept)[some])
        return out

    p, m = place(low), place(high)
    return n, p, m, points.before(p) - points.before(starts), points.before(m) - points.before(p)


def _buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of a string array and where each text starts and ends in them."""
    wide = pa.types.is_large_string(text.type) or pa.types.is_large_binary(text.type)
    size = text.offset + len(text) + 1
    places = np.frombuffer(text.buffers()[1], "<i8" if wide else "<i4", size)[text.offset :].astype(np.int64)
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    first = places[0]
    return data[first : places[-1]], places[:-1] - first, places[1:] - first


def _cut_batch(batch: pa.RecordBatch) -> dict[str, Any]:
    draws = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("h1", "h2", "h3", "h4")]
    marked = batch.column("marked").to_numpy(zero_copy_only=False).astype(bool)
    data, starts, ends = _buffer(batch.column("text"))
    n, p, m, prefix_chars, middle_chars = cuts(data, starts, ends, draws[0], draws[1])
    plain = (ends == starts) | marked | (draws[2] % 100 >= PLAIN_FROM)
    form = np.where(plain, "plain", np.where(draws[3] % 100 < SPM_BELOW, "spm", "psm"))
    raw = data.tobytes()
    p, m = np.where(plain, ends, p), np.where(plain, ends, m)
    return {
        "doc_id": batch.column("doc_id"),
        "n": n,
        "form": form.astype(object),
        "prefix_chars": pa.array(prefix_chars, mask=plain),
        "middle_chars": pa.array(middle_chars, mask=plain),
        "prefix": [raw[a:b] for a, b in zip(starts, p)],
        "middle": [raw[a:b] for a, b in zip(p, m)],
        "suffix": [raw[a:b] for a, b in zip(m, ends)],
    }


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2**32 from the sha256 of the seed and the id; a null id counts as an empty string."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name).cast("binary"), 256)
    return [
        F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)
    ]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """One row per document: units, form, sizes and the `output` text.

    psm is <P> prefix <S> suffix <M> middle, spm is <S> suffix <P> prefix <M> middle; plain is the text.
    """
    rows = common.documents(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    held = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        held = held | F.contains("text", F.lit(marker))
    asked = rows.select("doc_id", "text", held.alias("marked"), *draws(F.col("doc_id"), seed))
    pieces = asked.mapInArrow(common.per_batch(_cut_batch, SCHEMA), COLUMNS)
    prefix, middle, suffix = (F.col(c).cast("string") for c in ("prefix", "middle", "suffix"))
    output = (
        F.when(F.col("form") == "plain", prefix)
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    return pieces.select("doc_id", "n", "form", "prefix_chars", "middle_chars", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text, from the output and its form alone.

    No piece holds a marker, so the first of each is the one that was put there.
    """
    second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    size = len(PREFIX)
    ahead = F.substring_index(output, MIDDLE, 1)
    middle = F.substr(output, F.length(ahead) + size + 1)
    parts = F.substr(ahead, F.lit(size + 1))
    at = F.instr(parts, second)
    first, other = F.substr(parts, F.lit(1), at - 1), F.substr(parts, at + size)
    rebuilt = F.when(form == "psm", F.concat(first, middle, other)).otherwise(F.concat(other, middle, first))
    return F.when(form == "plain", output).otherwise(rebuilt)
