"""Summarise the physical plan of each analytics key as a Markdown table.

    python tools/plan_summary.py [sf_dir] > PLANS.md

For every key the plan is built twice: with the session's defaults (small
sides are broadcast by Spark's size check at this scale) and with broadcast
joins disabled, which is the shape the large tables take at cluster scale.
Counted from the plan before AQE re-planning: shuffle exchanges by kind,
broadcast exchanges, scans with pushed filters, whole-stage-codegen spans and
Python evaluation nodes.  Nothing is executed.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfwise.plans.analytics import QUERIES  # noqa: E402
from shelfwise.session import build_session, session_conf  # noqa: E402


def physical(df) -> str:
    # The initial plan AQE starts from (final plans exist only after a run).
    return df._jdf.queryExecution().executedPlan().toString()


def summary(plan: str) -> dict[str, int]:
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast": len(re.findall(r"BroadcastExchange", plan)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "python": len(re.findall(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)),
    }


def main(argv) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "16g"})
    print("# Plan shapes of the analytics keys\n")
    print(f"Produced by `python tools/plan_summary.py {sf_dir}`. Counts are taken from the physical plan")
    print("before AQE re-planning. *default*: the session as configured; small sides are broadcast by")
    print("Spark's size check. *no broadcast*: `autoBroadcastJoinThreshold=-1`, the shape the large")
    print("tables take at cluster scale. hash / range / single = shuffle exchanges by partitioning,")
    print("bcast = broadcast exchanges, pushed = scans with pushed filters, py = Python evaluation nodes.\n")
    print("| key | default: hash / range / single / bcast | no broadcast: hash / range / single / bcast | pushed | py |")
    print("| --- | --- | --- | --- | --- |")
    for key, fn in QUERIES.items():
        a = summary(physical(fn(spark, sf_dir)))
        with session_conf(spark, spark__sql__autoBroadcastJoinThreshold="-1",
                          spark__sql__adaptive__autoBroadcastJoinThreshold="-1"):
            b = summary(physical(fn(spark, sf_dir)))
        fmt = lambda s: f"{s['hash']} / {s['range']} / {s['single']} / {s['broadcast']}"
        print(f"| `{key}` | {fmt(a)} | {fmt(b)} | {a['pushed']} | {a['python']} |")
    print("\n`price_rank*` name their input three times (two copies of the histogram share one exchange at run time, and the rows).")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
