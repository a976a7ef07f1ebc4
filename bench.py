"""Time the headline queries: one JSON line, seconds per query (median of the timed runs)."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from membervane.catalog.queries import all_queries

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = (
    "window_averages",
    "history_flags",
    "rolling_max",
    "dedup_first",
    "join_two_key",
    "join_category",
    "row_index",
    "profile",
    "validate",
    "wasserstein",
    "quantile_rank",
    "bucket_drift",
    "percentile_to_value",
    "grid_stats",
    "segment_assign",
    "prepare_members",
    "value_members",
    "campaign_segments",
)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("SCRATCH_DIR") or tempfile.mkdtemp(prefix="membervane-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Spark otherwise records the calling line of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
