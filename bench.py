"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8) choose data and threads,
``BENCH_RUNS`` (default 3) the timed runs after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierflow.catalog import QUERIES  # noqa: E402
from tierflow.session import build_session  # noqa: E402

HEADLINE = [
    "customer_360", "branch_performance", "daily_bank_kpi", "risk_customer_summary",
    "transaction_channel_summary", "dash_total_kpis", "dash_top_customers", "dash_gateway",
    "audit_report", "params_pivot",
    "dedup_latest_row", "dedup_hot_key", "fill_defaults", "schema_cast_rules", "messy_timestamp_parse",
    "silver_encounters", "encounters_summary", "patients_demographics", "hospitals_directory",
    "physicians_directory", "zip_density_hot", "insight_longest_stay", "insight_top_spender",
    "balance_check", "orphan_keys", "star_dim_account", "star_accounts_by_kyc",
    "trips_partitioned", "rolling_two_months", "trip_kpis_monthly", "trip_top_dropoff_zones", "trip_yield",
    "social_users", "social_posts",
    "upsert_update_insert", "load_append", "load_merge", "stream_ingest_once", "stream_rescue",
]


# Whole runs take long and compile their code within one run: timed once.
WHOLE_RUNS = ["run_banking_customer_360", "run_hospital_gold_encounters", "run_star_fact", "run_trips_from_months"]


def run(spark, name: str, folder: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + WHOLE_RUNS)).split(",")
    spark = build_session(
        f"local[{cpus}]", app="bench", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        if name in WHOLE_RUNS:
            seconds[name] = round(run(spark, name, folder), 3)
            continue
        run(spark, name, folder)
        seconds[name] = round(statistics.median(run(spark, name, folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
