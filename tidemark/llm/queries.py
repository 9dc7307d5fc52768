"""The registered queries of the subpackage."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import session
from tidemark.llm import (
    chat,
    chunks,
    common,
    decontaminate,
    fill_middle,
    hard_negatives,
    langid,
    language_model,
    multi_index,
    neardup,
    neighbours,
    packing,
    pii,
    quality,
    secrets,
    substring,
)

for _module in (
    chunks, common, decontaminate, fill_middle, hard_negatives, langid, language_model, multi_index, neardup, neighbours,
    packing, pii, substring,
):
    session.ship_with_jobs(_module.__name__)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    session.apply_settings(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(table(spark, folder, "documents"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select("doc_id", *columns)


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = substring.deduplicate(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"), width=2)


def op4_language_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language_model.score(docs, common.id_remainder(F.col("doc_id")) != 1)
    return found.select(
        "doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digests(secrets.scan(table(spark, folder, "documents")))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).drop("ids")


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.digests(pii.scan(docs, pii.fit(docs)))


def op8_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    planted = spark.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    return chat.digests(chat.format_turns(rows.unionByName(planted)))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.judged(decontaminate.find_overlap(docs, items))


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    training = docs.filter(common.id_remainder(F.col("doc_id")) != 0)
    found = langid.predict(docs, langid.fit(training))
    return found.select(
        "doc_id", langid.is_held_out(F.col("fold")).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op11_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op13_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.transform(table(spark, folder, "documents"))
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_language_model": op4_language_model,
    "op5_secret_scan": op5_secret_scan,
    "op7_pii": op7_pii,
    "op8_chat_format": op8_chat_format,
    "op6_packing": op6_packing,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_fill_in_middle": op13_fill_in_middle,
}
