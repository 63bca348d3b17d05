"""From raw documents to packed training sequences: language, near-duplicates, personal data, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluicegate.llm import language, near_dup, packing, pii
from sluicegate.llm.library_bpe import library_encoder
from sluicegate.scratch import written

# Hundredths of similarity from which documents are near-duplicates.
LEAST_SIMILARITY = 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.in_known_languages(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.without_near_duplicates(docs, LEAST_SIMILARITY)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, lambda: library_encoder(path, False, True).encode)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("redact_pii", redact_pii),
    ("best_fit_packing", best_fit_packing),
]
# No SQL tells languages or knows the tokenizer; tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written, and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES, 1):
        made = stage(spark, docs, sf_dir)
        docs = written(made) if place < len(STAGES) else made
    return docs
