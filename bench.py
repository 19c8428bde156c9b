"""Time the headline queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run once to warm up (JIT, file listing cache) and then timed
``BENCH_REPS`` times (median reported).  A run materialises the full result
through the ``noop`` sink, so every stage executes but nothing is collected
to the driver.  Keys that write tables or files are timed once per
repetition including their writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfwise.plans.registry import query_registry  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

HEADLINE = [
    "orders_by_date_status",
    "top_date_status",
    "join_orders_items",
    "category_price_stats",
    "category_sums",
    "distinct_then_count",
    "bids_per_auction",
    "bids_per_auction_stats",
    "busiest_day_orders",
    "price_rank",
    "price_rank_cheap",
    "top10_customers",
    "customer_products",
    "distinct_products_top10",
    "month_key",
    "parse_date",
    "epoch_ms_to_date",
    "ddl_bucketed",
    "ddl_dynamic_partition",
    "io_parquet_snappy",
    "io_csv_gzip",
    "ingest_merge",
]


def run(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = build_session(master=f"local[{cpus}]", app_name="shelfwise-bench", shuffle_partitions=cpus, extra={"spark.driver.memory": "16g"})
    reg = query_registry()
    times: dict[str, float] = {}
    for key in HEADLINE:
        fn = reg[key]
        run(spark, fn, sf_dir)
        times[key] = round(statistics.median(run(spark, fn, sf_dir) for _ in range(reps)), 4)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum of median wall time over headline queries",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "reps": reps,
            }
        )
    )


if __name__ == "__main__":
    main()
