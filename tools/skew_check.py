"""Skew experiment: one user holds a third of all events.

Usage: python tools/skew_check.py <scratch_dir> [copies] [query ...]

Builds ONE enlarged copy of the driver's sf0.1 tables in ``scratch_dir/data``: events, orders
and lineitems replicated ``copies`` times with fresh keys, every third copy re-assigned to one
hot user / customer / order key, so each holds a third of its table. It then runs the event-heavy registered queries
with Spark's event log written to ``scratch_dir/eventlog``, and prints, per query, the wall
time and the worst stage's max/median task time. A plan that gathered the hot user's rows in
one task would show a large max/median ratio on a stage that reads all events.
"""

from __future__ import annotations

import glob
import json
import shutil
import statistics
import sys
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans.driver_queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

SOURCE = "/root/testdata/sf0.1"
HOT_USER = 7
HOT_ORDER = 11
DEFAULT_QUERIES = [
    "int_user_activity", "int_funnel_steps", "fct_funnel", "fct_cohort_weekly", "fct_feature_engagement",
    "funnel", "retention_weekly", "behavior_table", "dq_relationships", "dq_unique", "topline", "daily_metrics",
    "fct_ab_tests", "ab_rates", "ab_revenue_welch", "retention_monthly", "contract_duplicate_keys",
]


def build_copy(spark, data_dir: Path, copies: int) -> None:
    if (data_dir / "_READY").exists():
        return
    data_dir.mkdir(parents=True, exist_ok=True)
    enlarged = ("events.parquet", "orders.parquet", "lineitem.parquet")
    for f in glob.glob(f"{SOURCE}/*.parquet"):
        if not f.endswith(enlarged):
            shutil.copy(f, data_dir)
    reps = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    hot = F.col("k") % 3 == 0
    orders = spark.read.parquet(f"{SOURCE}/orders.parquet").withColumn("k", reps)
    orders.select(
        (F.col("o_orderkey") * copies + F.col("k")).alias("o_orderkey"),
        F.when(hot, F.lit(HOT_USER).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    ).repartition(64).write.mode("overwrite").parquet(str(data_dir / "orders.parquet"))
    items = spark.read.parquet(f"{SOURCE}/lineitem.parquet").withColumn("k", reps)
    items.select(
        F.when(hot, F.lit(HOT_ORDER).cast("bigint")).otherwise(F.col("l_orderkey") * copies + F.col("k")).alias("l_orderkey"),
        *[c for c in items.columns if c not in ("l_orderkey", "k")],
    ).repartition(64).write.mode("overwrite").parquet(str(data_dir / "lineitem.parquet"))
    ev = spark.read.parquet(f"{SOURCE}/events.parquet")
    big = ev.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    big = big.select(
        (F.col("event_id") * copies + F.col("k")).alias("event_id"),
        "ts",
        F.when(F.col("k") % 3 == 0, F.lit(HOT_USER).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        "event_type",
        "value",
        "props",
    )
    big.repartition(64).write.mode("overwrite").parquet(str(data_dir / "events.parquet"))
    (data_dir / "_READY").write_text("ok")


def stage_skew(log_dir: Path) -> list[dict]:
    """Per job group: stages with their task durations, from the JSON event log."""
    logs = sorted(glob.glob(str(log_dir / "*")), key=lambda p: Path(p).stat().st_mtime)
    newest = Path(logs[-1])
    files = sorted(p for p in newest.rglob("*") if p.is_file()) if newest.is_dir() else [newest]
    tasks = defaultdict(list)
    lines = (line for f in files if "appstatus" not in f.name for line in open(f))
    for line in lines:
        ev = json.loads(line)
        if ev.get("Event") == "SparkListenerTaskEnd":
            info = ev["Task Info"]
            tasks[(ev["Stage ID"], ev["Stage Attempt ID"])].append(info["Finish Time"] - info["Launch Time"])
    return tasks


def main(argv) -> None:
    scratch = Path(argv[1])
    copies = int(argv[2]) if len(argv) > 2 else 30
    names = argv[3:] or DEFAULT_QUERIES
    log_dir = scratch / "eventlog"
    log_dir.mkdir(parents=True, exist_ok=True)
    spark = build_session(
        "local[8]",
        shuffle_partitions=64,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": str(log_dir),
            "spark.eventLog.compress": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.local.dir": str(scratch / "local"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    data_dir = scratch / "data"
    build_copy(spark, data_dir, copies)
    total = spark.read.parquet(str(data_dir / "events.parquet")).count()
    hot = spark.read.parquet(str(data_dir / "events.parquet")).filter(F.col("user_id") == HOT_USER).count()
    print(f"events={total} hot_user_share={hot / total:.3f}")
    seen = set(stage_skew(log_dir))
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, str(data_dir)).write.format("noop").mode("overwrite").save()
        secs = time.perf_counter() - t0
        time.sleep(1.0)  # let the listener flush
        tasks = stage_skew(log_dir)
        new = {k: v for k, v in tasks.items() if k not in seen}
        seen |= set(tasks)
        worst = max(
            ((max(v) / max(statistics.median(v), 1), max(v), statistics.median(v), len(v)) for v in new.values() if len(v) >= 4),
            default=(1.0, 0, 0, 0),
        )
        print(f"{name:24s} {secs:7.2f}s  stages={len(new):3d}  worst stage max/median task ms = "
              f"{worst[1]}/{worst[2]:.0f} ({worst[0]:.1f}x over {worst[3]} tasks)")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
