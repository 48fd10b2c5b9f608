"""Bench: headline warehouse queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is fully computed (``count`` over the whole result after a
``noop`` write, so every column is produced, not pruned away).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "visitor_stats", "user_jump", "unique_visit", "new_visitor_repair", "log_page", "log_display",
    "order_wide", "payment_wide", "province_stats", "product_stats_dims", "gmv_by_day",
    "keyword_stats", "cdc_current_state", "route_prune_columns", "dim_latest_version",
]


def main() -> None:
    from cartwheel.plans.catalog import queries
    from cartwheel.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="cartwheel-bench")
    q = queries()
    # warm-up: JVM, parquet footers, code generation
    q["tumble_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t = time.time()
        q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
