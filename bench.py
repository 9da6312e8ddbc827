"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5; median after one warm-up). Each run executes the full
plan into Spark's ``noop`` sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog_sync.plans import registered  # noqa: E402
from catalog_sync.session import local_session, release_scratch  # noqa: E402

HEADLINE = [
    "upsert_with_change_detection",
    "merge_stats",
    "cleanup_orphans",
    "parse_properties",
    "search_props_having",
    "product_export",
    "sync_catalog",
    "find_similar",
    "similar_for_all",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = registered.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - t0
    release_scratch()
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16)
    results = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)  # warm-up
        times = [run_once(spark, name, sf_dir) for _ in range(runs)]
        results[name] = round(statistics.median(times), 4)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    # scaling check: the same queries on the 10x smaller TESTDATA, if present
    small_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), f"sf{sf / 10:g}") if sf else None
    small = {}
    if small_dir and os.path.isdir(small_dir) and os.environ.get("BENCH_SCALING", "1") == "1":
        for name in HEADLINE:
            run_once(spark, name, small_dir)
            small[name] = round(statistics.median(run_once(spark, name, small_dir) for _ in range(3)), 4)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "queries_at_sf_div_10": small,
        "time_ratio_10x_rows": round(sum(results.values()) / sum(small.values()), 3) if small else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
