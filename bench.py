"""Headline queries on one machine: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8). Batch queries are the median of
three warm runs into a sink that discards rows; streaming queries run once, with their result read.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from changefold.plans.catalog import QUERIES
from changefold.session import local_session

BATCH = [
    "p1_envelope_fields",
    "p6_clean_projection",
    "f7_expect_all_or_drop",
    "f8_expectation_counts",
    "f9_quarantine",
    "c1_scd1_strict",
    "c1_scd1_repaired",
    "c6_scd2_strict",
    "c7_scd2_repaired",
    "c9_dedup_delivery",
    "c10_constraint_violations",
    "c11_two_column_key",
]
STREAMS = ["s2_landing_counts", "s3_bronze_stream", "s6_clean_stream", "t1_refresh_products", "t1_refresh_history"]


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, sf_dir, "c1_scd1_repaired")
    times = {}
    for name in BATCH:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(3)), 3)
    for name in STREAMS:
        times[name] = round(seconds(spark, sf_dir, name), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))


if __name__ == "__main__":
    main()
