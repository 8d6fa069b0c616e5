"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8).  Each query is forced to completion with a no-op write, so
the whole plan runs without collecting rows to the driver.  Session start
and a JVM warm-up (a few queries on the smallest tables, sf0.001, so no
data of the measured scale is cached) are excluded from the timings.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakestrata.plans.registry import QUERIES  # noqa: E402
from lakestrata.session import local_session  # noqa: E402

HEADLINE = [
    "bronze_enrich",
    "bronze_merge_new",
    "silver_typed",
    "silver_flags",
    "field_diagnosis",
    "gold_counts",
    "value_class_counts",
    "gold_severity",
    "severity_means",
    "types_seen",
    "stream_bronze",
    "daily_gold_counts",
]


WARM_UP = ["bronze_enrich", "silver_flags", "gold_counts", "bronze_merge_new", "daily_gold_counts"]
WARM_UP_SF_DIR = "/root/testdata/sf0.001"


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="lakestrata-bench")
    for name in WARM_UP:  # JVM warm-up on the smallest tables
        run(QUERIES[name](spark, WARM_UP_SF_DIR))
    times = {}
    for name in names:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
