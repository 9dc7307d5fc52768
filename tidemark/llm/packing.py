"""Sum-of-squares packing of token ids into sequences.

Online, one partition of documents at a time. A level array counts the open sequences by fill. A
document goes to the fill level that leaves the smallest sum of squared counts; ties go to the
fullest. Documents longer than a sequence fill whole ones first and place the rest. At the end of a
partition the few open sequences are emptied and refilled back to back, and what then remains is
cut into sequences whose lengths are powers of two, which need no padding.

Each partition packs by itself, so nothing is shuffled, memory holds open sequences only, and a
task that runs again makes the same sequences from the same input partition. Sequence ids carry the
partition in their upper bits.

Null text is an empty document, and an empty document is the end id alone. Repeated rows are packed
each. No rows: no pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm import common

LENGTH = 4096
END_ID = 2
VOCABULARY = "word_bpe_49k.json"
#: Words whose ids a worker keeps, also while it is idle: so many met of late, and as many of those before.
WORDS_KEPT = 150_000
#: Words of letters that are encoded as one text.
TOGETHER = 500
#: New words whose encodings are held at a time.
AT_ONCE = 5_000
#: Bytes of texts whose words are looked up at a time.
BLOCK_BYTES = 2 << 20
FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
FOLDED = np.frombuffer(FOLD, np.uint8)
#: Kinds of bytes. Where a word of ASCII letters or digits meets other ASCII, it is cut; the vocabulary never merges across.
SPACE, LETTER, OTHER, REST = range(4)
KIND = np.array(
    [
        SPACE if chr(c) in common.SPACES
        else LETTER if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789"
        else OTHER if c < 128 and chr(c) not in "'<"
        else REST
        for c in range(256)
    ],
    np.uint8,
)
#: Bytes of ids in one Arrow batch of results.
BATCH_BYTES = 4 << 20

PIECES = (
    "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_of(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def word_encoder(tokenizer, end_id: int) -> Callable[[pa.Array | list[str | None]], list[bytes]]:
    """Ids of texts as little-endian bytes, with the end id.

    The vocabulary lower-cases, drops white space and merges only inside words, so the ids of a text
    are those of its words in order. Words are cut out of all the texts at once by array work and told apart by
    Arrow, so that Python sees each of the distinct ones once. A word is encoded once and looked up after that; words
    that have not been met for a while are forgotten. The strings of the vocabulary's added tokens are found in the
    text as it is, across words, so a text that may hold one is encoded whole.
    """
    added = [t.content.encode().translate(FOLD) for t in tokenizer.get_added_tokens_decoder().values()]
    known = Words(tokenizer)

    def encode(texts: pa.Array | list[str | None]) -> list[bytes]:
        if isinstance(texts, list):
            texts = pa.array([t and t.encode("utf-8", "replace") for t in texts], pa.binary())
        texts = texts.cast(pa.binary()).fill_null(b"")
        if not len(texts):
            return []
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        low = FOLDED[data]
        words, starts = words_of(low, ends)
        coded = words.dictionary_encode()
        flat, sizes, first = known.ids_of(coded.dictionary)
        flat, sizes, first = np.append(flat, np.uint32(end_id)), np.append(sizes, 1), np.append(first, len(flat))
        # The end id comes as one more word behind each text.
        behind = np.searchsorted(starts, ends[1:])
        word = np.insert(coded.indices.to_numpy(), behind, len(sizes) - 1)
        n = sizes[word]
        stops = np.cumsum(n)
        source = np.repeat(first[word] - (stops - n), n)
        source += np.arange(len(source))
        ids = flat[source].tobytes()
        cuts = [0, *(4 * stops[behind + np.arange(len(texts))]).tolist()]
        out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        folded = low.tobytes()
        if any(c in folded for c in added):
            for i, text in enumerate(texts.to_pylist()):
                if any(c in text.translate(FOLD) for c in added):
                    whole = tokenizer.encode(text.decode(), add_special_tokens=False).ids
                    out[i] = np.array([*whole, end_id], "<u4").tobytes()
        return out

    return encode


class Words:
    """Words with their ids, in arrays, which take a fraction of the memory of Python objects."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        top = max(tokenizer.get_vocab().values()) + 1
        self.ends_word = np.zeros(top, bool)
        if suffix:
            self.ends_word[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.words = pa.array([], pa.binary())
        self.ids = np.zeros(0, "<u4")
        self.sizes = np.zeros(0, np.int64)
        self.met = np.zeros(0, bool)

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids back to back, and of each of the (distinct) words their number and where they begin."""
        at = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.words) + np.arange(len(new))
            some = words.take(pa.array(new))
            made = [self.encoded(some.slice(k, AT_ONCE).to_pylist()) for k in range(0, len(some), AT_ONCE)]
            self.words = pa.concat_arrays([self.words, some])
            self.ids = np.concatenate([self.ids, *(ids for ids, _ in made)])
            self.sizes = np.concatenate([self.sizes, *(sizes for _, sizes in made)])
            self.met = np.append(self.met, np.ones(len(new), bool))
        self.met[at] = True
        found = self.ids, self.sizes[at], (np.cumsum(self.sizes) - self.sizes)[at]
        if self.met.sum() > WORDS_KEPT:
            self.words = self.words.filter(pa.array(self.met))
            self.ids, self.sizes = self.ids[np.repeat(self.met, self.sizes)], self.sizes[self.met]
            self.met = np.zeros(len(self.sizes), bool)
        return found

    def encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words back to back, and their numbers.

        Words of letters are encoded many at a time as one text. Each has at least one id that ends a word, so
        if there are as many of these as words, each of them ends one; otherwise the words are encoded one by one.
        """
        texts = [w.decode() for w in words]
        plain = [i for i, t in enumerate(texts) if t.isalpha()]
        groups = [plain[k : k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
        found: list[tuple[list[int], np.ndarray, np.ndarray]] = []
        joined = self.tokenizer.encode_batch_fast([" ".join(texts[i] for i in g) for g in groups], add_special_tokens=False)
        apart = sorted({*range(len(words))}.difference(plain))
        for group, encoding in zip(groups, joined):
            ids = np.array(encoding.ids, np.int64)
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) == len(group) and stops[-1] == len(ids):
                found.append((group, ids, np.diff(stops, prepend=0)))
            else:
                apart += group
        each = [e.ids for e in self.tokenizer.encode_batch_fast([texts[i] for i in apart], add_special_tokens=False)]
        found.append((apart, np.array([x for ids in each for x in ids], np.int64), np.array([len(ids) for ids in each], np.int64)))
        # From the order of encoding to that of the words.
        place = np.argsort(np.array([i for group, _, _ in found for i in group], np.int64))
        sizes = np.concatenate([n for _, _, n in found])
        begin = (np.cumsum(sizes) - sizes)[place]
        sizes = sizes[place]
        source = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return np.concatenate([ids for _, ids, _ in found])[source].astype("<u4"), sizes


def words_of(low: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of the texts that lie back to back in `low`, and where each begins there."""
    kind = KIND[low]
    before = np.zeros_like(kind)
    before[1:] = kind[:-1]
    before[ends[:-1][ends[:-1] < len(low)]] = SPACE
    solid = kind != SPACE
    first = solid & ((before == SPACE) | ((kind == OTHER) & (before == LETTER)))
    letters = low[solid]
    offsets = np.append(np.flatnonzero(first[solid]), len(letters)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers), np.flatnonzero(first)


def blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of some `BLOCK_BYTES`; a text is not cut."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    number = (np.cumsum(sizes) - sizes) // BLOCK_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):
        yield texts.slice(a, b - a)


class Packer:
    """Places documents one after another; `take` yields the pieces of sequences that are complete."""

    def __init__(self, length: int, first_id: int) -> None:
        self.length = length
        self.next_id = first_id
        self.counts = np.zeros(length + 1, np.int64)  # open sequences by fill
        self.open: dict[int, list[list[tuple]]] = {}

    def level_for(self, size: int) -> int:
        """The level whose choice leaves the smallest sum of squares; 0 opens a sequence."""
        top = self.length - size
        counts = self.counts
        levels = np.flatnonzero(counts[1 : top + 1]) + 1
        opened = 2 * counts[size] + 1 if size < self.length else 0
        if not len(levels):
            return 0
        change = np.where(
            levels == top, 1 - 2 * counts[levels], 2 * (counts[levels + size] - counts[levels]) + 2
        )
        best = change.min()
        return int(levels[change == best][-1]) if best <= opened else 0

    def take(self, doc_id: int | None, ids: bytes) -> Iterator[list[tuple]]:
        total = len(ids) // 4
        at = 0
        while total - at >= self.length:
            yield [(doc_id, at, ids[4 * at : 4 * (at + self.length)], total)]
            at += self.length
        if at == total:
            return
        size = total - at
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
        pieces.append((doc_id, at, ids[4 * at :], total))
        if level + size == self.length:
            yield pieces
        else:
            self.open.setdefault(level + size, []).append(pieces)
            self.counts[level + size] += 1

    def rest(self) -> Iterator[list[tuple]]:
        """The open sequences refilled back to back, then lengths that are powers of two."""
        queue = [p for level in sorted(self.open, reverse=True) for s in self.open[level] for p in s]
        left = sum(len(p[2]) // 4 for p in queue)
        queue.reverse()
        while left:
            goal = self.length if left >= self.length else 1 << (left.bit_length() - 1)
            pieces, room = [], goal
            while room:
                doc_id, start, ids, total = queue.pop()
                n = len(ids) // 4
                if n > room:
                    queue.append((doc_id, start + room, ids[4 * room :], total))
                    ids, n = ids[: 4 * room], room
                pieces.append((doc_id, start, ids, total))
                room -= n
            left -= goal
            yield pieces
        self.open.clear()
        self.counts[:] = 0

    def numbered(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            yield doc_id, start, n, ids, zlib.crc32(ids), total, self.next_id, offset
            offset += n
        self.next_id += 1


def packing(path: str | None, length: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        where = path or vocabulary_path()
        encode = common.cached(("words", where, end_id), lambda: word_encoder(tokenizer_of(where), end_id))
        packer = Packer(length, TaskContext.get().partitionId() << 40)
        ready: list[tuple] = []
        held = 0

        def sequences() -> Iterator[list[tuple]]:
            for batch in batches:
                ids = iter(batch.column("doc_id").to_pylist())
                for texts in blocks(batch.column("text")):
                    for encoded in encode(texts):
                        yield from packer.take(next(ids), encoded)
                    common.give_back()
            yield from packer.rest()

        for sequence in sequences():
            for piece in packer.numbered(sequence):
                ready.append(piece)
                held += len(piece[3])
            if held >= BATCH_BYTES:
                yield as_batch(ready)
                ready, held = [], 0
        if ready:
            yield as_batch(ready)
        common.give_back()

    return run


def as_batch(pieces: list[tuple]) -> pa.RecordBatch:
    columns = zip(*pieces)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    length: int = LENGTH,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: its document, the place there, the ids (little-endian), the sequence and offset."""
    return common.documents(docs, id_col, text_col).mapInArrow(packing(tokenizer_path, length, end_id), PIECES)
