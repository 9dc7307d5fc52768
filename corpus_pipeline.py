"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Quality rules drop documents outside the limits of their language and source; of near-duplicate groups
one document stays; documents that hold benchmark passages go; secrets are masked in the text; what
is left is packed into sequences of token ids. SQL has no tokenizer, so there is no SQL for it all; tests hold
what the stages keep against plain versions on small tables, and the packed rows against the stages.
Empty tables give no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark import session
from tidemark.llm import common, decontaminate, neardup, packing, quality, queries, secrets


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.apply_settings(spark)
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.apply_settings(spark)
    return neardup.keep_one(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.apply_settings(spark)
    return secrets.mask_secrets(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    session.apply_settings(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_overlap", benchmark_overlap),
    ("secret_masking", secret_masking),
    ("sequence_packing", sequence_packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; each one's rows go to the shared folder and are deleted when the next has read them."""
    docs = queries.table(spark, sf_dir, "documents")
    folder = f"{session.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            common.delete(spark, before)
        before = f"{folder}/{name}"
    return docs
