"""Edge inputs from FIXTURES.md part 3."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwise.functions import cleaning, dates
from shelfwise.operators import ingest
from shelfwise.session import scratch_path, session_time_zone
from shelfwise.sources import catalog


def test_quoted_pipe_text(spark):
    path = scratch_path(spark, "quoted")
    spark.createDataFrame([('a|"x|y"|',)], "value string").write.text(path)
    df = spark.read.schema("c1 string, c2 string, c3 string").option("sep", "|").option("quote", '"').csv(path)
    assert [tuple(r) for r in df.collect()] == [("a", "x|y", None)]


def test_header_skipped(spark):
    path = scratch_path(spark, "header")
    spark.createDataFrame([("name\tqty",), ("bolt\t3",)], "value string").coalesce(1).write.text(path)
    name = "hdr_tab"
    catalog.create_table(spark, name, spark.createDataFrame([], "name string, qty int").schema,
                         using="csv", options={"sep": "\t", "header": "true"})
    catalog.load_delimited(spark, name, path, sep="\t", header=True)
    assert [tuple(r) for r in spark.table(name).collect()] == [("bolt", 3)]


def test_nulls_empty_strings_and_sentinels(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", None)], "id int, a string, b string")
    cleaned = cleaning.empty_to_null(df)
    assert [tuple(r) for r in cleaned.orderBy("id").collect()] == [(1, None, "x"), (2, None, None)]
    with_num = spark.createDataFrame([(1, None, None)], "id int, s string, n double")
    filled = cleaning.fill_null_sentinels(with_num)
    assert tuple(filled.first()) == (1, "NA", -1000.0)


def test_numeric_strings_safe_casts(spark):
    df = spark.createDataFrame([("12.5",), ("",), ("150.5",), ("abc",)], "s string")
    got = df.select(cleaning.to_int("s").alias("i"), cleaning.to_float("s").alias("f")).collect()
    assert [r.i for r in got] == [12, None, 150, None]
    assert [r.f for r in got][0] == 12.5 and [r.f for r in got][1] is None


def test_dates_parse_and_reject(spark):
    df = spark.createDataFrame([("2009-03-20",), ("2000-01-01 10:20:30",), ("bad",)], "s string")
    with session_time_zone(spark, "UTC"):
        got = df.select(
            dates.parse_to_epoch_s("s").alias("e"),
            dates.parse_date("s").alias("d"),
            dates.date_part_of("s").alias("p"),
        ).collect()
    assert got[0].e == 1237507200 and got[0].d == dt.date(2009, 3, 20)
    assert got[1].p == dt.date(2000, 1, 1)
    assert got[2].e is None and got[2].d is None and got[2].p is None


def test_epoch_ms(spark):
    df = spark.createDataFrame([(1374735600000,)], "ms long")
    with session_time_zone(spark, "UTC"):
        r = df.select(dates.epoch_ms_to_date("ms").alias("d"), dates.epoch_ms_to_month("ms").alias("m")).first()
    assert r.d == dt.date(2013, 7, 25) and r.m == "2013-07"


def test_epoch_ms_before_1970(spark):
    df = spark.createDataFrame([(-1,), (-86_400_000,), (-2_678_400_001,)], "ms long")
    with session_time_zone(spark, "UTC"):
        got = df.select(dates.epoch_ms_to_date("ms").alias("d"), dates.epoch_ms_to_month("ms").alias("m")).collect()
    assert [r.d for r in got] == [dt.date(1969, 12, 31), dt.date(1969, 12, 31), dt.date(1969, 11, 30)]
    assert [r.m for r in got] == ["1969-12", "1969-12", "1969-11"]


def test_overlapping_snapshots_newest_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (4, "D")], "k int, v string")
    got = sorted(tuple(r) for r in ingest.merge_by_key(old, new, "k").collect())
    assert got == [(1, "a"), (2, "B"), (3, "C"), (4, "D")]


def test_merge_repeated_keys_no_pairs(spark):
    old = spark.range(0, 200).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    new = spark.range(0, 300).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    assert ingest.merge_by_key(old, new, "k").count() == 300


def test_insert_rows_with_null(spark):
    name = "literal_rows_t"
    spark.sql(f"CREATE TABLE {name} (id int, title string, price double, qty int, label string) USING parquet")
    spark.sql(f"INSERT INTO {name} VALUES (7, 'oak shelf', 31.5, 2, 'NEW'), (8, 'tin box', 4.0, null, 'SOLD OUT')")
    rows = {r.id: r for r in spark.table(name).collect()}
    assert rows[8].qty is None and rows[7].label == "NEW"


def test_split_first(spark):
    df = spark.createDataFrame([("NATION_1|1|a",), ("x.y|2",), ("alone",)], "line string")
    got = df.select(*cleaning.split_first("line", "|")).collect()
    assert [tuple(r) for r in got] == [("NATION_1", "1|a"), ("x.y", "2"), ("alone", None)]


def test_buckets_stay_legal():
    assert catalog.buckets_for_bytes(10) == 1
    assert catalog.buckets_for_bytes(10, minimum=4) == 4
    assert catalog.buckets_for_bytes(1 << 40) == 4096
    assert catalog.buckets_for_bytes(100 << 40) == catalog.MAX_BUCKETS < 100_000


def test_appended_files_are_read(spark):
    from shelfwise.sources.tables import Tables

    root = scratch_path(spark, "appended")
    spark.range(10).write.parquet(f"{root}/part.parquet")
    assert Tables(spark, root).part.count() == 10
    spark.range(20).write.mode("append").parquet(f"{root}/part.parquet")
    assert Tables(spark, root).part.count() == 30


def test_stream_counts_every_batch(spark):
    from shelfwise.streaming.incremental import read_target, run_available_now

    landing, target, state = (scratch_path(spark, n) for n in ("many-in", "many-out", "many-state"))
    spark.range(0, 1100, 1, 110).write.parquet(landing)  # more files than Spark keeps progress entries
    schema = spark.read.parquet(landing).schema
    assert run_available_now(spark, landing, schema, target, state, max_files_per_trigger=1) == 110
    assert read_target(spark, target).count() == 1100
    assert run_available_now(spark, landing, schema, target, state) == 0
    spark.range(5).coalesce(1).write.mode("append").parquet(landing)
    assert run_available_now(spark, landing, schema, target, state) == 1
    assert read_target(spark, target).count() == 1105


def test_session_takes_master_and_partitions_only_if_given(monkeypatch):
    from pyspark.sql import SparkSession

    from shelfwise import session

    given = {}

    class Builder:
        def __getattr__(self, name):
            def call(*args):
                given[args[0] if name == "config" else name] = args[-1] if args else None
                return self

            return call

        def getOrCreate(self):
            return type("S", (), {"sparkContext": type("C", (), {"setLogLevel": lambda self, x: None})()})()

    monkeypatch.setattr(SparkSession, "builder", Builder())
    session.build_session()
    assert not {"master", "spark.sql.shuffle.partitions", "spark.driver.memory"} & set(given)
    session.build_session(master="local[2]", shuffle_partitions=3)
    assert given["master"] == "local[2]" and given["spark.sql.shuffle.partitions"] == "3"
