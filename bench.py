"""Time the headline queries and the full refresh; prints one JSON line.

BENCH_SF_DIR   data folder  (default /root/testdata/sf0.1)
BENCH_CPUS     local cores  (default 8)
BENCH_QUERIES  comma-separated names, to time others
"""

from __future__ import annotations

import json
import os
import time

from ledgerguard.plans import bindings as b
from ledgerguard.plans import queries  # noqa: F401
from ledgerguard.plans.refresh import refresh
from ledgerguard.plans.registry import QUERIES
from ledgerguard.session import scratch, session
from ledgerguard.sources.layers import LayerStore

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "q1_user_history", "q4_by_reference", "q8_monthly_spend", "q9_top_merchants", "q11_merchants_by_region",
    "q13_daily_totals", "q15_weekly_summary", "q18_balance_violations", "q19_duplicate_keys",
    "a4_transaction_anomalies", "a5_conflict_groups", "a6_idempotency_conflicts_lineitem",
    "k4_missing_core_reference", "k8_route", "k9_routing_summary", "c2_core_accounts", "c7_core_from_route",
    "c8_constraints_transactions", "e1_profile_events", "e3_duplicates", "e10_orphans", "r3_date_order",
    "r5_idempotency_payload", "r8_sequence_gaps", "v16_conservation", "i4_running_daily_totals",
    "i5_latest_per_user",
]

STAGED = {
    "transactions": b.staged_transactions, "users": b.staged_users, "accounts": b.staged_accounts,
    "merchants": b.staged_merchants, "agencies": b.staged_agencies, "wilayas": b.staged_wilayas,
    "tx_types": b.staged_tx_types, "categories": b.staged_categories,
}


def full_refresh(spark, sf: str) -> None:
    """Staging to core, issue tables, constraint report and summary, all stored."""
    store = LayerStore(spark, scratch(spark, "bench"))
    for table, rows in STAGED.items():
        store.replace(rows(spark, sf), "staging", table)
    refresh(spark, store, lookup_rows=None).collect()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session(
        f"local[{CPUS}]", "ledgerguard-bench",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="20g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    QUERIES["q13_daily_totals"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # warm the JVM

    times = {}
    for name in names:
        times[name] = timed(
            lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    if names == HEADLINE:
        times["full_refresh"] = timed(lambda: full_refresh(spark, SF_DIR))
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
