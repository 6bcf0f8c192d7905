"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (3).
The lineitem and orders tables are first dealt into one file per core (not timed): the test files
are one row group each, which would scan on one core, while a table at scale has many splits.
Each query runs once to warm up, then BENCH_REPEAT times; the median wall time is reported.
Queries are executed in full through the ``noop`` sink (no collect of large results).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratum.plans.registry import QUERIES  # noqa: E402
from stratum.session import get_spark  # noqa: E402

HEADLINE = ["silver", "dim_location", "dim_vehicle", "fact", "monthly_metrics",
            "borough_metrics", "check_suite", "incremental_window", "page_numbers",
            "dedupe_latest"]


def run_once(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def spread_tables(spark, sf_dir: str) -> str:
    """A folder like ``sf_dir`` whose tables that the headline queries scan have many files."""
    folder = tempfile.mkdtemp(prefix="stratum-bench-")
    for name in os.listdir(sf_dir):
        if name in ("lineitem.parquet", "orders.parquet"):
            table = spark.read.parquet(f"{sf_dir}/{name}")
            table.repartition(spark.sparkContext.defaultParallelism).write.parquet(f"{folder}/{name}")
        else:
            os.symlink(f"{sf_dir}/{name}", f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(app_name="stratum-bench")
    timings, tables = {}, spread_tables(spark, sf_dir)
    for name in names:
        run_once(spark, name, tables)
        timings[name] = round(statistics.median(run_once(spark, name, tables)
                                                for _ in range(repeat)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
