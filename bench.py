"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs ``BENCH_RUNS`` times
in a warm session, to a sink that discards the rows; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from stagewright.session import local_session
from workload import QUERIES

HEADLINE = [
    "load_txn_fact",
    "load_txn_fact_staged",
    "load_member_dim",
    "load_member_dim_daily",
    "load_child_dim",
    "array_profile",
    "tier_case",
    "left_join_receipts",
    "left_join_chain",
    "left_join_of_date",
    "filter_date_or_null",
    "surrogate_key",
    "distinct_subquery",
    "safe_cast",
    "time_parts",
    "jdbc_partitioned_read",
    "delimited_header_read",
    "documents_flattened",
    "stage_dynamic_overwrite",
    "ingest_all_sources",
    "load_all_targets",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
