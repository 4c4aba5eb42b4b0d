"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is forced in full with the ``noop`` sink (no driver transfer).
The flight lake table is materialised first and timed on its own, like
the batch ETL that feeds the SQL users.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skyframe.plans import catalog  # noqa: E402
from skyframe.plans.q_flights import cleaned, raw  # noqa: E402
from skyframe.session import get_spark  # noqa: E402

HEADLINE = [
    "clean_flights", "avg_delay_ranking", "busiest_routes", "delay_by_temperature",
    "named_flights_by_airline", "named_query_answers", "group_stat_median", "describe",
    "kde_distance", "correlation_matrix", "stratified_sample", "split_3way", "resample_groups",
    "build_features", "numeric_drift", "monitor_report", "bias_report", "latest_users",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = get_spark(f"local[{cpus}]", app="skyframe-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    times = {}
    t0 = time.time()
    raw(spark, sf_dir)
    times["materialise_flights"] = round(time.time() - t0, 3)
    t0 = time.time()
    cleaned(spark, sf_dir)
    times["materialise_processed"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        if only and name not in only:
            continue
        fn = catalog.QUERIES.get(name)
        if fn is None:
            continue
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
