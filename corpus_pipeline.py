"""Corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on every row its predecessor kept and returns a DataFrame. All but the
last return the columns of ``documents``, further ones included whatever their names. ``run`` writes each stage's rows as Parquet in the shared folder and rereads
them as the next one's input, so a lost executor never reaches back beyond one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, line_dedup, packing, simhash
from tidemark.llm.common import store

# a document is rejected if it has no letters or no language reaches this mean probability
MIN_LANGUAGE_SCORE = 0.4
# of texts, sent to a Python worker at a time; a batch is held several times over: as Arrow in the JVM and the worker, as
# text, as UTF-8 and as the worker's results
BATCH_BYTES = 2 << 20


def _small_batches(spark: SparkSession) -> None:
    """From now on the session's Python workers get batches of ``BATCH_BYTES``, or one row if that is longer, instead
    of 10,000 rows: what was once touched for a batch stays with an executor. A session setting, as the rows are only
    computed after the stage has returned; no result depends on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _applied(docs: DataFrame, needed: list[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows ``operator`` keeps, with the columns of ``docs``. It sees those it needs under their own names and the
    others under numbered ones, so a column called like one of its results passes unchanged."""
    names = [c if c.lower() in needed else f"carried_{i}" for i, c in enumerate(docs.columns)]
    return operator(docs.toDF(*names)).select(names).toDF(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is recognised."""
    _small_batches(spark)
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return _applied(docs, ["doc_id", "text", "lang"], lambda d: langid.identify(d).where(known))


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated lines out of the texts; a document may be left with an empty text."""
    out = _applied(docs, ["doc_id", "text"], line_dedup.dedup_lines)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    _small_batches(spark)
    return _applied(docs, ["doc_id", "text"], simhash.keep_one_of_each)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = lambda d: decontaminate.contamination(d, benchmark).where(~F.col("contaminated"))
    return _applied(docs, ["doc_id", "text"], clean)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their token ids."""
    _small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", sequence_packing),
]

# the network of the first stage has no SQL form; the tests hold the rows against a plain-Python version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
