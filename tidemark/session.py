"""Spark session settings shared by the library, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (timestamps are stored without zone and
# all date truncation happens in UTC), ANSI arithmetic, and adaptive execution so the
# shuffle partition count, join strategy and skewed partitions are re-planned at runtime.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    On a cluster ``master`` stays ``None`` and comes from ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the SQL settings that can change on a running session (driver-supplied sessions)."""
    for key, value in BASE_CONF.items():
        if key.startswith("spark.sql."):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf on a shared session: leave it to the owner
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; we only create our own when nothing is set
    (local tests), never overriding the cluster's choice.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            # a machine-local folder would not survive a lost executor on a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current
