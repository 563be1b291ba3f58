"""Persisted, bucketed models (S12): tables stored by hash of their join key, and definitions that outlive the session.

A model is written once, bucketed and sorted by its key (``user_id`` or ``event_id``). Joins and aggregations by that key
then need no exchange on a stored side (J1, J3, M4, M5, Q5), whatever runs later. Each model leaves a definition under
``<root>/_models/<name>/<version>`` (columns, buckets, folder, or the SQL of a view), written after its data; :func:`open_models` of another
session declares the newest version of each again. Older versions stay until :func:`drop_old_versions`, so readers that
opened them finish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.io import hadoop_path, path_exists

BYTES_PER_BUCKET = 256 << 20


def bucket_count(n_bytes: int, bytes_per_bucket: int = BYTES_PER_BUCKET) -> int:
    """A power of two, so that tables of other sizes can still be joined by reading several buckets together."""
    return 1 << max(0, (max(1, -(-n_bytes // bytes_per_bucket)) - 1).bit_length())


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _table_name(name: str, version: str) -> str:
    return _quoted(f"{name}_{version}".lower())


def _declare(spark: SparkSession, definition: dict) -> DataFrame:
    name = definition["name"]
    if "sql" in definition:
        df = spark.sql(definition["sql"])
    else:
        table = _table_name(name, definition["version"])
        schema = T.StructType.fromJson(definition["schema"])
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
        keys = ", ".join(map(_quoted, definition["keys"]))
        place = definition["path"].replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet"
            f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {definition['buckets']} BUCKETS LOCATION '{place}'"
        )
        df = spark.table(table)
    df.createOrReplaceTempView(name)
    return df


def _define(spark: SparkSession, root: str, definition: dict) -> DataFrame:
    text = spark.createDataFrame([(json.dumps(definition),)], "definition string")
    text.coalesce(1).write.mode("error").text(f"{root}/_models/{definition['name']}/{definition['version']}")
    return _declare(spark, definition)


def _new_version() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f") + uuid.uuid4().hex[:6]


def save_model(df: DataFrame, root: str, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` bucketed and sorted by ``keys``, one file per bucket, and return it as read from the table."""
    spark, root, version = df.sparkSession, root.rstrip("/"), _new_version()
    path = f"{root}/{name}/{version}"
    table = _table_name(name, version)
    # one task per bucket: a bucket is one sorted file, so its order holds when it is read
    dealt = df.repartition(buckets, *keys)
    dealt.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    definition = {"name": name, "version": version, "path": path, "keys": list(keys), "buckets": buckets, "schema": schema.jsonValue()}
    return _define(spark, root, definition)


def save_view(spark: SparkSession, root: str, name: str, sql: str) -> DataFrame:
    """Keep a model as SQL over other models of the same root."""
    return _define(spark, root.rstrip("/"), {"name": name, "version": _new_version(), "sql": sql})


def definitions(spark: SparkSession, root: str) -> dict[str, dict]:
    """The newest definition of each model, in the order in which they were made."""
    folder = f"{root.rstrip('/')}/_models"
    if not path_exists(spark, folder):
        return {}
    rows = spark.read.option("recursiveFileLookup", True).text(folder).collect()  # a short text per version
    found = sorted((json.loads(r[0]) for r in rows), key=lambda x: x["version"])
    newest = {x["name"]: x for x in found}
    return dict(sorted(newest.items(), key=lambda x: x[1]["version"]))


def open_models(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Declare every stored model in this session, as a DataFrame and a temporary view of its name."""
    return {name: _declare(spark, d) for name, d in definitions(spark, root).items()}


def drop_old_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """Remove all versions of a model but the newest."""
    root = root.rstrip("/")
    keep = definitions(spark, root)[name]["version"]
    gone = []
    for folder in (f"{root}/_models/{name}", f"{root}/{name}"):
        fs, p = hadoop_path(spark, folder)
        for status in fs.listStatus(p) if fs.exists(p) else ():
            version = status.getPath().getName()
            if version != keep:
                fs.delete(status.getPath(), True)
                spark.sql(f"DROP TABLE IF EXISTS {_table_name(name, version)}")
                gone.append(version)
    return sorted(set(gone))


def column_bytes(df: DataFrame) -> int:
    """A rough size of a table from its text columns and eight bytes for each other one: one aggregation."""
    sizes = [F.coalesce(F.octet_length(f.name), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8) for f in df.schema]
    total = sizes[0]
    for s in sizes[1:]:
        total = total + s
    return int(df.agg(F.coalesce(F.sum(total.cast("long")), F.lit(0))).first()[0])
