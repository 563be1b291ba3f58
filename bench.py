"""Benchmark: time every registered query on the driver's tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query, default 1; one warm-up run precedes them).
Each run executes the full plan with a ``noop`` sink (no collect). Prints ONE JSON line:
{"metric": ..., "value": total of per-query medians, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.driver_queries import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = build_session(
        f"local[{cpus}]",
        app_name="tidemark-bench",
        shuffle_partitions=cpus * 2,
        extra_conf={
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            "spark.local.dir": scratch,
            "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 4)
    match = re.search(r"sf([0-9.]+)", sf_dir.rstrip("/"))
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
