"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and print one JSON line.

Every query runs end to end into a ``noop`` sink: one warm-up, then the median of the runs. The inputs are the
dirty views derived from the given tables, so their joins are part of every time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from sievewright.catalog.queries import REGISTRY  # noqa: E402
from sievewright.session import AT_START, RUNTIME  # noqa: E402

HEADLINE = [
    "etl_batch_clean", "quarantine_all", "quality_report", "etl_financials_clean", "stream_etl_clean",
    "clean_strings", "rule_nulls", "rule_special_chars", "rule_type_dirty_rows", "rule_region_conflicts",
    "rule_typos_levenshtein", "dedup_primary_key", "load_new_only", "audit_string_changes",
]


def session(cpus: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        # The input fits one split and one broadcast. Plan as on a cluster, where it does not: joins shuffle,
        # and every core gets a share of the rows.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.sql.files.maxPartitionBytes", "2m")
        .config("spark.sql.files.openCostInBytes", "256k")
    )
    for key, value in {**RUNTIME, **AT_START}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "runs": runs,
        "orders": rows,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
