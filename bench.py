"""Benchmark of the headline queries.

Runs each query of ``HEADLINE`` on the tables in ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``: one warm-up run, then
the median of ``$BENCH_REPEAT`` (default 3) timed runs. A run is a full
evaluation of every output column (``noop`` sink), not a count that the
optimizer could prune. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "clean_staffing",
    "valid_staffing",
    "duplicate_keys",
    "facility_daily",
    "facility_quarterly",
    "staffing_quality",
    "state_summary",
    "low_staffing",
    "readmission_quality",
    "not_null_results",
    "overview_kpis",
    "quality_detail",
    "profile_statistics",
]


def session(cpus: str):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("staffwise-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(cpus) if cpus.isdigit() else 16)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="staffwise-bench-"))
    return spark


def run_once(spark, fn, sf_dir) -> float:
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = session(cpus)
    from staffwise.plans.queries import QUERIES

    names = only or HEADLINE
    results, errors = {}, {}
    for name in names:
        fn = QUERIES[name]
        try:
            run_once(spark, fn, sf_dir)  # warm-up
            results[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(repeat)), 3)
        except Exception as e:  # keep timing the others; report the failure
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
