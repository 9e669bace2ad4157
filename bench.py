"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     set to time every query
BENCH_REPEATS runs of each query, of which the median counts (default 3); the first warms up
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

os.environ.setdefault("TZ", "UTC")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = [
    "incremental_window",
    "incremental_string_ts",
    "next_watermark",
    "dq_unique",
    "dq_first_failure",
    "dq_outcomes",
    "dq_all_failures",
    "dedup_latest_row",
    "classify_changes",
    "merge_upsert",
    "merge_repeated_target",
    "load_merge",
    "merge_partitions",
    "step_profile",
    "run_report",
    "dependency_ready",
    "two_loads",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-"))
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # start the engine before the clock
    times = {}
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    for name in names:
        taken = []
        for _ in range(repeats):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        times[name] = round(median(taken), 3)
    spark.stop()
    result = {
        "metric": "headline queries, total wall time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
