"""Language identification by compression.

For each language a raw-content zstandard dictionary is filled with labelled texts. A text is
compressed with each dictionary and belongs to the language that makes it smallest. The score is the
margin to the second smallest, as a share of it; texts with a margin under `least_margin` are marked
as rejected. Texts are lower-cased and reduced to letters first, and compressed in blocks that each
start from the dictionary: else the rest of a long text would count as its own dictionary.

The dictionaries come from a bounded sample: of each language the `DOCS_PER_LANGUAGE` documents with
the smallest id hash, cut at `DICTIONARY_BYTES` in all. Every text is classified, whole.

Null text, or text without a letter: `und`, score 0. Nothing learned: `und` for all. Null labels are
not learned from. Ties go to the language first in the alphabet, with score 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import common

DOCS_PER_LANGUAGE = 400
DICTIONARY_BYTES = 64 << 10
BLOCK_BYTES = 4096
LEVEL = 6
LEAST_MARGIN = 0.02
UNKNOWN = "und"

SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("rejected", pa.bool_()),
        ("fold", pa.int64()),
    ]
)


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = DOCS_PER_LANGUAGE,
    dictionary_bytes: int = DICTIONARY_BYTES,
) -> dict[str, bytes]:
    """The dictionary of each language, from a sample of bounded size."""
    rows = common.documents(docs, id_col, text_col, F.col(lang_col).cast("string").alias("lang"))
    return dictionaries(rows, docs_per_language, dictionary_bytes)


def dictionaries(rows: DataFrame, docs_per_language: int, dictionary_bytes: int) -> dict[str, bytes]:
    usable = rows.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("h", F.xxhash64("doc_id"))
    first = Window.partitionBy("lang").orderBy("h")
    cuts = (
        usable.select("lang", "h")
        .distinct()
        .withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= docs_per_language)
        .groupBy("lang")
        .agg(F.max("h").alias("cut"))
        .collect()
    )
    if not cuts:
        return {}
    sampled = F.lit(False)
    for lang, cut in cuts:
        sampled = sampled | ((F.col("lang") == lang) & (F.col("h") <= F.lit(cut)))
    texts = (
        usable.filter(sampled)
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", 1, dictionary_bytes)).alias("text"))
        .orderBy("lang", "h")
    )
    made: dict[str, bytearray] = {}
    for lang, _, text in texts.toLocalIterator():
        held = made.setdefault(lang, bytearray())
        if len(held) < dictionary_bytes:
            held += letters(text)[: dictionary_bytes - len(held)]
    return {lang: bytes(made[lang]) for lang in sorted(made)}


LETTERS = bytes(c if c >= 0x80 or 97 <= c <= 122 else 32 for c in range(256))


def letters(text: str) -> bytes:
    """Lower case, ASCII other than letters as spaces, one space between words."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(LETTERS).split()) + b" "


def compressors(learned: dict[str, bytes], level: int) -> list[tuple[str, object]]:
    import zstandard as zstd

    made = []
    for lang, content in learned.items():
        shared = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(level=level)
        made.append((lang, zstd.ZstdCompressor(level=level, dict_data=shared, write_content_size=False, write_dict_id=False)))
    return made


def classify(text: str | None, using: list[tuple[str, object]]) -> tuple[str, float]:
    if not text or not using or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    raw = letters(text)
    blocks = [raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in using)
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0]


def predict(
    docs: DataFrame,
    learned: dict[str, bytes],
    id_col: str = "doc_id",
    text_col: str = "text",
    level: int = LEVEL,
    least_margin: float = LEAST_MARGIN,
) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and rejected (the margin is too narrow) of each row."""
    rows = common.documents(docs, id_col, text_col).withColumn("fold", common.id_remainder(F.col("doc_id")))
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    key = str(shared._jbroadcast.id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        using = common.cached(("zstd", key, level), lambda: compressors(shared.value, level))
        for batch in batches:
            said = [classify(t, using) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([lang for lang, _ in said], pa.string()),
                    pa.array([score for _, score in said], pa.float64()),
                    pa.array([lang == UNKNOWN or score < least_margin for lang, score in said], pa.bool_()),
                    batch.column("fold"),
                ],
                schema=SCHEMA,
            )

    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean, fold long")


def is_held_out(fold: Column) -> Column:
    return F.coalesce(fold == 0, F.lit(False))
