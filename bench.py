"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` is the table folder, ``BENCH_CPUS`` the number of cores. Each
query is written in full to the ``noop`` sink: all of them once to warm up, then
the median of ``BENCH_RUNS`` runs each. Queries that store something do so in each run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paymart.queries import QUERIES  # noqa: E402
from paymart.session import get_session  # noqa: E402

HEADLINE = [
    "global_metrics_by_status",
    "global_metrics",
    "global_metrics_by_status_of_events",
    "metrics_for_day",
    "run_sql_file",
    "metrics_backfill",
    "account_day_totals",
    "account_day_status_totals",
    "join_rates",
    "currency_names",
    "dashboard_source",
    "turnover_by_currency",
    "active_accounts_by_currency",
    "avg_transactions_per_account",
    "company_turnover",
    "decode_envelope",
    "decode_payload",
    "transactions_from_messages",
    "dedup_by_id",
    "encode_messages",
    "quarantine",
    "upsert_do_nothing",
    "upsert_do_update",
    "not_null_report",
    "unique_key_report",
    "domain_report",
    "missing_rate_report",
    "read_rates_csv",
    "append_transactions",
    "insert_new",
    "replace_days",
    "ingest_messages",
    "ingest_troubled_messages",
    "insert_or_update",
    "load_rates",
    "global_metrics_large_amounts",
    "stream_decode",
    "stream_dedup_bounded",
    "stream_upsert",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    settings = {
        "spark.master": f"local[{cpus}]",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.log.level": "ERROR",
    }
    spark = get_session("paymart-bench", **settings)

    for name in names:
        run(spark, name, sf_dir)
    seconds = {}
    for name in names:
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(runs)), 3)
        print(f"{name:40s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)

    print(
        json.dumps(
            {
                "metric": "total of median seconds per headline query",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cores": int(cpus),
                "spark": spark.version,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
