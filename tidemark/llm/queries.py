"""Registered queries of the corpus operators and their DuckDB statements.

Every query applies its operator, with production parameters, to whole tables and derives the contract's columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    html_text,
    langid,
    line_dedup,
    max_sketch,
    packing,
    pii,
    prefix_trie,
    quality_rules,
    simhash,
    superkmer,
    url_rules,
    warc,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    out = packing.pack(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer, with_tokens=False)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


# host, path, verdict
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return index.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "index_range", "index_place"
    )


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    )
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumn("base_sha256", F.sha2(F.col("base_spans").cast("binary"), 256)).drop("base_spans")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.apply_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_sketch.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = superkmer.dedup_windows(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_packing": op2_packing,
    "op3_url_filter": op3_url_filter,
    "op4_language_id": op4_language_id,
    "op5_warc": op5_warc,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_pii": op9_pii,
    "op10_quality_rules": op10_quality_rules,
    "op11_ranked_search": op11_ranked_search,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_substring_dedup": op13_substring_dedup,
}
