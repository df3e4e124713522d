"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_REPEATS  timed runs per query after one warm-up; the median counts (default 3)
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

import pyspark

from barloom.session import build_session
from barloom.workload import QUERIES

HEADLINE = [
    "bars_between", "sort_symbol_time", "latest_bar_per_symbol", "coverage", "monthly_avg_close_orders",
    "duplicate_times", "column_stats", "canonical_symbol", "coerce_lenient", "dedupe_first", "fill_forward",
    "fill_backward", "fill_interpolate", "fill_mean", "fill_median", "fill_sequence", "roll_points", "back_adjust",
    "count_gaps", "list_gaps", "missing_hours", "missing_business_days", "chunk_ranges_daily", "quality_gate",
    "staleness_and_gaps", "isolate_failures_good", "insert_ignore", "priority_union", "stable_bucket",
    "clean_futures_bars", "clean_equity_bars", "read_equity_json", "insert_ignore_stored", "delete_stored",
    "ingest_equities",
    "fill_forward_split", "fill_interpolate_split", "fill_median_split", "back_adjust_split", "clean_equity_bars_forward_split",
]


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in HEADLINE:
        run(spark, name, folder)
        timings[name] = round(statistics.median(run(spark, name, folder) for _ in range(repeats)), 3)
        print(f"{timings[name]:8.3f} {name}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline queries, sum of median wall times",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(scale.group(1)) if scale else None,
        "cpus": int(cpus),
        "spark": pyspark.__version__,
        "shuffle_partitions": int(cpus),
    }))


if __name__ == "__main__":
    main()
