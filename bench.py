"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from sparkmart.registry import QUERIES
from sparkmart.session import build_session

HEADLINE = (
    "orders_enriched_lineitem",
    "orders_enriched",
    "shopify_orders",
    "shopify_order_lines",
    "customers_enriched",
    "discount_codes_enriched",
    "ga4_events",
    "meta_ad_stats_daily",
    "google_campaigns",
    "fct_campaign_performance_daily",
    "latest_order_per_customer",
    "shipping_delay",
    "line_money",
    "incremental_delete_insert",
    "scd2_history",
    "dq_star_report",
    "campaign_performance_daily",
    "dq_table_report",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__driver__extraJavaOptions="-XX:ReservedCodeCacheSize=512m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    small_dir = os.environ.get("BENCH_SMALL_SF_DIR", "/root/testdata/sf0.01")
    times: dict[str, float] = {}
    plans: dict[str, float] = {}
    small: dict[str, float] = {}
    for name in names:
        # the first run warms up; the smaller size shows what part of the time doesn't grow
        planned, taken = zip(*(timed(spark, name, sf_dir) for _ in range(runs + 1)))
        times[name] = round(statistics.median(taken[1:] or taken), 3)
        plans[name] = round(statistics.median(planned[1:] or planned), 3)
        small[name] = round(timed(spark, name, small_dir)[1], 3)
        print(name, [round(t, 2) for t in taken], plans[name], small[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_median_warm",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "plan_building": plans,
                "smaller_size": {"sf": scale(small_dir), "queries": small},
                "sf": scale(sf_dir),
            }
        )
    )


def scale(sf_dir: str) -> str:
    return os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")


def timed(spark, name: str, sf_dir: str) -> tuple[float, float]:
    """Seconds until the plan is built, and until all rows are made."""
    start = time.perf_counter()
    df = QUERIES[name].run(spark, sf_dir)
    planned = time.perf_counter() - start
    df.write.format("noop").mode("overwrite").save()
    return planned, time.perf_counter() - start


if __name__ == "__main__":
    main()
