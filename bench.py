"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     1 times every registered query
BENCH_RUNS    timed rounds over all queries after two warm-up rounds (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmart import workload  # noqa: E402

HEADLINE = (
    "mart_monthly_sales",
    "fct_sales_converted",
    "stg_sales",
    "stg_sales_large_dimension",
    "cross_rates",
    "inverse_rates",
    "policy_filter_then_mask",
    "policy_mask_tail",
    "json_schema_read",
    "raw_quarantine",
    "full_refresh",
    "model_chain_view",
    "registry_validate",
    "registry_insert_absent",
    "registry_update",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("sparkmart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        # Recording a Python call site per column costs time and helps debugging only.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = workload.queries()
    names = list(registered) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    taken = {name: [] for name in names}
    for _ in range(runs + 2):
        for name in names:
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken[name].append(time.perf_counter() - start)
    seconds = {name: round(statistics.median(times[2:]), 3) for name, times in taken.items()}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of median warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
