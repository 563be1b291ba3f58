"""Small helpers shared by the corpus operators: text expressions and tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# white space of the word rules: space and U+0009 to U+000D
SPACES = " \t\n\x0b\x0c\r"
SPACE_WORD = r"[^\x20\x09-\x0D]+"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` can use it many times and it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII text takes the faster built-in, with the same result."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def find_words(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` in order; no words for null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.array().cast("array<string>"))


def space_words(text: Column) -> Column:
    """Runs of anything but space and U+0009-U+000D, in order; no words for null, empty and blank texts."""
    none = F.array().cast("array<string>")
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)),
        lambda t: F.when(t == "", none).otherwise(F.split(t, SPACE_RUN, -1)),
    )


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name (case is ignored, as Spark does)."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = "_" + wanted
    return wanted
