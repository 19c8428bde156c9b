"""Per-stage task balance under a hot key, from Spark's event log.

    python tools/skew_report.py [sf_dir]

Builds skewed copies of the test tables -- one customer placing a third of
all orders, one day holding a third of all orders, one department holding a
third of all products -- runs the operators that group or join on those keys
(noop sink), and reads the event log written to a fresh scratch folder.  For
every stage that reads a shuffle it prints the number of tasks, the shuffle
records read and the largest share of them read by a single task.  With 8
tasks an even split is 0.125; a task holding the hot key alone would show
>= 0.33.  (The test tables are single row groups, so their scans are one task
each and are left out.)  Broadcasts and partition coalescing are switched
off so the operators' own partitioning is what is measured.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shelfwise.operators import aggregates as agg  # noqa: E402
from shelfwise.operators.ranking import rank_within  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

HOT = 7


def hot_third(df, order_col, col, value):
    """``col`` set to ``value`` on the first third of rows by ``order_col``."""
    third = df.agg(F.max(order_col)).first()[0] // 3
    return df.withColumn(col, F.when(F.col(order_col) <= third, F.lit(value)).otherwise(F.col(col)))


def main(argv) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = build_session(
        master="local[8]",
        app_name="shelfwise-skew",
        shuffle_partitions=8,
        extra={
            "spark.driver.memory": "16g",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": f"file://{log_dir}",
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            # Show the operators' own balance: no broadcast shortcuts, and
            # every shuffle partition as its own task (no coalescing).
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        },
    )
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    orders, lineitem, part = read("orders"), read("lineitem"), read("part")
    hot_customer = hot_third(orders, "o_orderkey", "o_custkey", HOT)
    hot_day = hot_third(orders, "o_orderkey", "o_orderdate", None).withColumn(
        "o_orderdate", F.coalesce("o_orderdate", F.lit("1995-06-17 00:00:00").cast("timestamp_ntz")))
    hot_dept = hot_third(part, "p_partkey", "p_size", HOT)

    runs = {
        "customer_products (hot customer)": lambda: agg.customer_product_counts(
            agg.customer_product_pairs(hot_customer, lineitem, order_key="o_orderkey",
                                       order_customer="o_custkey", item_order_key="l_orderkey",
                                       item_product="l_partkey"),
            read("customer"), customer_id="c_custkey", customer_name="c_name"),
        "sales_by_day_status (hot day)": lambda: agg.sales_by_day_status(
            hot_day, lineitem, order_key="o_orderkey", item_order_key="l_orderkey",
            order_day=F.to_date("o_orderdate"), status="o_orderstatus", amount="l_extendedprice"),
        "busiest_day_rows (hot day)": lambda: agg.busiest_day_rows(hot_day, F.to_date("o_orderdate")),
        "rank_within distributed (hot department)": lambda: rank_within(
            hot_dept, ["p_size"], "p_retailprice"),
    }
    sc = spark.sparkContext
    for name, build in runs.items():
        sc.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.stop()

    stage_group: dict[int, str] = {}
    records: dict[int, list[int]] = defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    records[ev["Stage ID"]].append(n)
    print("| run | stage | tasks | shuffle records read | largest task share |")
    print("| --- | --- | --- | --- | --- |")
    for sid in sorted(records):
        xs = records[sid]
        total = sum(xs)
        if total == 0 or stage_group.get(sid) not in runs:
            continue
        print(f"| {stage_group[sid]} | {sid} | {len(xs)} | {total} | {max(xs) / total:.3f} |")
    print(f"\nevent log: {log_dir}")


if __name__ == "__main__":
    main(sys.argv[1:])
