"""rank_within against Spark's own window functions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.operators.ranking import rank_within


def _by_window(df, groups, order, ascending=True):
    key = F.col(order).asc_nulls_first() if ascending else F.col(order).desc_nulls_last()
    w = Window.partitionBy(*groups).orderBy(key)
    return df.withColumn("rank", F.rank().over(w).cast("bigint")).withColumn("dense_rank", F.dense_rank().over(w).cast("bigint"))


def _same(a, b):
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_tied_ranks(spark):
    # FIXTURES: three rows, two with one price -> rank 1,1,3; dense 1,1,2
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 5.0), (1, 12, 7.0)], "d int, p int, price double")
    ranked = rank_within(df, ["d"], "price", steps=2)
    assert {r.p: (r["rank"], r.dense_rank) for r in ranked.collect()} == {10: (1, 1), 11: (1, 1), 12: (3, 2)}


def test_skewed_group_matches_window(spark):
    # One department holds most rows and one price most of that department.
    rows = [(0, i, float(i % 97)) for i in range(3000)]
    rows += [(0, 10_000 + i, 13.0) for i in range(2000)]
    rows += [(g, 20_000 + g * 10 + i, float(i)) for g in range(1, 6) for i in range(10)]
    df = spark.createDataFrame(rows, "d int, p int, price double").repartition(7)
    _same(rank_within(df, ["d"], "price", steps=16), _by_window(df, ["d"], "price"))


def test_nulls_and_descending(spark):
    rows = [(1, 1, None), (1, 2, 3.0), (1, 3, None), (1, 4, 1.0), (2, 5, None), (None, 6, 2.0), (None, 7, 2.0)]
    df = spark.createDataFrame(rows, "d int, p int, price double")
    for asc in (True, False):
        _same(rank_within(df, ["d"], "price", ascending=asc, steps=3), _by_window(df, ["d"], "price", asc))


def test_two_group_columns(spark):
    rows = [(a, b, i, float((i * 7) % 11)) for a in range(3) for b in range(2) for i in range(40)]
    df = spark.createDataFrame(rows, "a int, b int, p int, v double")
    _same(rank_within(df, ["a", "b"], "v", steps=5), _by_window(df, ["a", "b"], "v"))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))),
        min_size=1,
        max_size=60,
    ),
    st.integers(1, 9),
)
def test_property_matches_window(spark, rows, steps):
    data = [(g, i, v) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, id int, v int")
    _same(rank_within(df, ["g"], "v", steps=steps), _by_window(df, ["g"], "v"))


def test_sampled_range_bounds_match_window(spark):
    # 200k distinct (group, value) pairs: far more than the range partitioner's
    # sample, so the bucket bounds come from sampling.
    df = spark.range(0, 200_000, numPartitions=16).selectExpr(
        "cast(id % 3 as int) as g", "id", "cast((id * 7919) % 200003 as double) as v"
    )
    _same(rank_within(df, ["g"], "v", steps=16), _by_window(df, ["g"], "v"))


def test_filter_above_distributed_rank_keeps_ranks(spark):
    # W3: ranks are computed before the price filter.
    from shelfwise.plans import analytics
    from shelfwise.sources.tables import Tables

    from conftest import SF01

    base = analytics._dept_products(Tables(spark, SF01))
    cheap = F.col("product_price") < 5000
    d = rank_within(base, ["department_id"], "product_price", steps=3).where(cheap)
    w = _by_window(base, ["department_id"], "product_price").where(cheap)
    _same(d, w)


def test_many_rows_of_one_value(spark):
    rows = [(g, i, float(v)) for g in range(3) for v, n in ((1, 5), (2, 700), (3, 1), (4, 300)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, id int, v double").repartition(6)
    for steps in (2, 5, 4000):
        for asc in (True, False):
            _same(rank_within(df, ["g"], "v", steps=steps, ascending=asc), _by_window(df, ["g"], "v", asc))


def test_odd_values_and_clashing_names(spark):
    nan, rows = float("nan"), []
    for i, v in enumerate([nan, 0.0, -0.0, None, nan, 1.5, float("inf"), -float("inf"), 0.0] * 9):
        rows.append((None if i % 4 == 0 else f"g{i % 3}", v, i, i, i))
    df = spark.createDataFrame(rows, "g string, v double, _part int, _row long, _tie int")
    for steps in (1, 1000):
        _same(rank_within(df, ["g"], "v", steps=steps).na.fill(9e9), _by_window(df, ["g"], "v").na.fill(9e9))
    empty = df.where("false")
    assert rank_within(empty, ["g"], "v").count() == 0
    text = df.select("g", "_row", F.col("v").cast("string").alias("v"))
    _same(rank_within(text, ["g"], "v", steps=5), _by_window(text, ["g"], "v"))


def test_bucket_never_falls(spark):
    """Every type's bucket keeps the order of its values."""
    import datetime as dt

    from pyspark.sql import types as T

    from shelfwise.operators.ranking import _bucket

    moments = [dt.datetime(1931, 5, 6, 7, 8, 9), dt.datetime(1969, 12, 31, 23, 59, 59), dt.datetime(1970, 1, 1), dt.datetime(2024, 3, 31, 2, 30)]
    cases = [
        (T.DoubleType(), [-float("inf"), -1e300, -3.5, -1.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 900.0, 900.01, 1e12, float("inf"), float("nan")]),
        (T.LongType(), [-(2**63), -5, -1, 0, 1, 2, 10**6, 10**6 + 1, 2**53, 2**53 + 1, 2**63 - 1]),
        (T.DateType(), [m.date() for m in moments]),
        (T.TimestampType(), moments),
        (T.TimestampNTZType(), moments),
        (T.StringType(), ["", "\0", "A", "Aa", "B", "a", "aa", "ab", "abc", "abd", "é", "日本", "🙂"]),
        (T.BooleanType(), [False, True]),
    ]
    for kind, values in cases:
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", kind)]))
        found = [r.b for r in df.select("i", _bucket(F.col("v"), kind).alias("b")).orderBy("i").collect()]
        assert found == sorted(found) and None not in found, kind


def test_plan_is_lazy(spark):
    """Building the ranking runs no job and writes nothing."""
    df = spark.range(1000).selectExpr("id % 3 as g", "id as v")
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    plan = rank_within(df, ["g"], "v")
    assert sorted(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == sorted(before)
    assert "Scan parquet" not in plan._jdf.queryExecution().executedPlan().toString()
