"""Global positions (S15): the place of every row in a total order, without a task that sees all rows.

Rows are range-partitioned by the order and stored with their partition's number; the partitions' counts give each one an
offset, and a row's position is its place in its partition plus that offset. The order columns must include a key that
makes it total: with it, however many rows share a first order value, the ranges cut between them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir


def global_position(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "position", partitions: int | None = None
) -> DataFrame:
    """``df`` with its 1-based ``name`` in the order; rows that tie in all order columns get following numbers."""
    if name in df.columns or "_part" in df.columns:
        raise ValueError(f"the table already has a column {name} or _part")
    spark = df.sparkSession
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *order)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/positions-{uuid.uuid4().hex}"
    # stored: a repeated range partitioning could cut elsewhere
    ranged.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(path)
    offsets, so_far = [], 0
    for part, n in stored.groupBy("_part").count().orderBy("_part").collect():  # a row per partition
        offsets.append((part, so_far))
        so_far += n
    before = F.broadcast(spark.createDataFrame(offsets, "_part int, _before long"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return stored.withColumn("_place", place).join(before, "_part").select(
        *[f"`{c}`" for c in df.columns], (F.col("_before") + F.col("_place")).alias(name)
    )
