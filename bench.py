"""Runs the batch queries at one scale and prints one JSON line with seconds per query.

Every query is written to Spark's no-op sink, so all its rows are produced and none are kept.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from eventide.plans.catalog import batch_queries
from eventide.session import build_session

HEADLINE = [
    "hot_items_hop_count", "hot_items_topn", "hot_items_sql", "topn_report", "topn_changelog",
    "hot_urls_hop_count", "hot_urls_topn", "channel_behavior_hop_count", "ad_clicks_by_province",
    "pv_hourly", "pv_hourly_salted", "uv_hourly", "uv_hourly_bitmap", "uv_hourly_approx", "uv_running",
    "ad_click_capped", "ad_blacklist", "login_fail_pair", "login_fail_episode", "login_fail_run",
    "login_fail_two_step", "order_pay_match", "order_pay_timeout", "order_status", "order_late_payment",
    "pay_receipt_interval_join", "pay_receipt_reconcile", "pay_without_receipt", "receipt_without_pay",
    "parse_behavior_log", "parse_login_log", "parse_order_log", "parse_receipt_log", "parse_ad_log",
    "parse_access_log", "pv_filter", "get_requests",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", cores=cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    queries = batch_queries()
    chosen = sys.argv[1:] or HEADLINE

    def once(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once("pv_hourly")  # starts the executors and code generation
    seconds = {}
    for name in chosen:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    print(json.dumps({"metric": "total_warm_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "cores": cores, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
