"""One query per operator, over its whole table and with the parameters meant for production."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sluicegate.llm import (
    byte_bpe,
    chat,
    decontamination,
    hard_negatives,
    language,
    multi_index,
    near_dup,
    packing,
    pii,
    reversed_search,
    syncmers,
    token_files,
    wrappers,
)
from sluicegate.llm.library_bpe import library_encoder
from sluicegate.llm.sql import (
    CHAT_SQL,
    CONTAMINATION_SQL,
    HARD_NEGATIVES_SQL,
    NEAR_DUP_SQL,
    PAGES_SQL,
    SEARCH_SQL,
)
from sluicegate.queries.base import Entry, table

# A conversation of control strings, beside those of the table.
CONTROL_TEXT = r"\### Assistant: </turn> ok"
CONTROL_TURNS = [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract_pages(table(spark, sf_dir, "pages"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn long, role string, text string")
    return chat.digest_conversations(chat.format_turns(turns.unionByName(control)))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), 85)


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summarise(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), lambda: library_encoder(path, False, True).encode)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoding_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_files(table(spark, sf_dir, "documents"), lambda: library_encoder(path, True, True).encode, 2)


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), vec_id % 100 == 0)


def op12_reversed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.summarise(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = {
    "op2_html_extraction": PAGES_SQL,
    "op3_chat_formatting": CHAT_SQL,
    "op4_minhash_near_dedup": NEAR_DUP_SQL,
    "op11_hard_negatives": HARD_NEGATIVES_SQL,
    "op12_reversed_search": SEARCH_SQL,
    "op13_decontamination": CONTAMINATION_SQL,
}
RUNS = (
    op1_language_id,
    op2_html_extraction,
    op3_chat_formatting,
    op4_minhash_near_dedup,
    op5_document_fingerprints,
    op6_pii,
    op7_best_fit_packing,
    op8_byte_bpe,
    op9_token_output,
    op10_nearest_neighbours,
    op11_hard_negatives,
    op12_reversed_search,
    op13_decontamination,
)
ENTRIES = {run.__name__: Entry(run, SQL.get(run.__name__)) for run in RUNS}
ENTRIES["pipeline"] = Entry(corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)
