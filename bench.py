"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated names, default the headline list).
"""

from __future__ import annotations

import json
import os
import time

from orderloom.session import local_session
from orderloom.workload import fixtures
from orderloom.workload.queries import QUERIES

HEADLINE = (
    "norm_order norm_document_text dup_in_file dup_lines validate_all reason_summary "
    "create_orders_bulk validate_legacy customer_dim_ids customer_upsert resolve_customer "
    "migrate_legacy orders_append csv_scan browse_orders sort_code_desc status_stats "
    "lookup_code delete_outcomes command_replay live_orders audit_rows status_transitions "
    "history_position"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    started = time.perf_counter()
    fixtures.loaded_store(spark, sf_dir)
    timings["import_seeds_and_intake"] = round(time.perf_counter() - started, 3)
    for name in names:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, second run of each",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cores": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
