"""Compare each analytic key with two comparators at one scale factor.

    python tools/baseline_compare.py [sf_dir] [reps]

* ``shelfwise``: the registered query (full result through the noop sink);
* ``spark_sql``: the straightforward SQL formulation (the oracle SQL) run by
  Spark on temp views of the same parquet files -- the plan Spark picks for
  the textbook query;
* ``duckdb``: the same SQL on DuckDB, single node, all cores.

Prints a markdown table (median of ``reps`` runs after one warm-up).
"""

from __future__ import annotations

import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from shelfwise.plans import analytics  # noqa: E402
from shelfwise.plans.registry import oracle_queries  # noqa: E402
from shelfwise.session import build_session  # noqa: E402
from shelfwise.sources.tables import TABLE_NAMES, Tables  # noqa: E402


def timed(fn, reps):
    fn()
    xs = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        xs.append(time.perf_counter() - t0)
    return statistics.median(xs)


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    reps = int(argv[1]) if len(argv) > 1 else 3
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "16g"})
    Tables(spark, sf_dir).register_views()
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    sql = oracle_queries()
    print("| key | shelfwise s | Spark SQL (textbook) s | DuckDB s |")
    print("| --- | --- | --- | --- |")
    for key, fn in analytics.QUERIES.items():
        mine = timed(lambda: fn(spark, sf_dir).write.format("noop").mode("overwrite").save(), reps)
        try:
            naive = timed(lambda: spark.sql(sql[key]).write.format("noop").mode("overwrite").save(), reps)
            naive_s = f"{naive:.3f}"
        except Exception:
            naive_s = "n/a (DuckDB-only syntax)"
        duck = timed(lambda: con.execute(sql[key]).fetchall(), reps)
        print(f"| {key} | {mine:.3f} | {naive_s} | {duck:.3f} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
