"""Headline queries, timed once each after a warm-up; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from shelftide.plans.queries import QUERIES
from shelftide.session import drop_run_tables, local_session
from shelftide.sources.storage import discard

HEADLINE = (
    "store_revenue_outlier", "pair_life_cohort", "series_days", "series_positions",
    "array_lengths", "profile_demand", "abc_six_rules", "profile_base", "pivot_class",
    "fingerprint_hash", "fingerprint_counts", "check_days", "check_profile",
    "hierarchy_path_names", "order_frontier", "weekday_strength", "baseline_errors")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "shelftide-bench")
    spark.sparkContext.setLogLevel("ERROR")
    discard(QUERIES["pair_life_cohort"](spark, sf_dir))

    seconds = {}
    for name in HEADLINE:
        if name in QUERIES:
            started = time.perf_counter()
            discard(QUERIES[name](spark, sf_dir))
            seconds[name] = round(time.perf_counter() - started, 3)
    drop_run_tables(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
