"""Imports in equal splits, and merges that rewrite only what changes."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import ingest
from shelfwise.session import scratch_path, unique_name


def _files(spark, name):
    return {f.split("/")[-2] + "/" + f.split("/")[-1] for f in spark.table(name).inputFiles()}


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def keyed(spark):
    df = spark.range(0, 4000).selectExpr("id as k", "concat('v', id) as v")
    return ingest.create_keyed(df, unique_name("keyed"), "k", 20)


def test_small_delta_rewrites_its_ranges_only(spark, keyed):
    before = _files(spark, keyed)
    assert len({f.split("/")[0] for f in before}) == 20
    new = spark.createDataFrame([(1010, "new"), (1015, "new"), (3999, "new")], "k long, v string")
    assert ingest.merge_into_keyed(spark, keyed, new) == {"rewritten": 2, "appended": 0, "kept": 18}
    after = _files(spark, keyed)
    changed = {f.split("/")[0] for f in before ^ after}
    assert len(changed) == 2 and len(before & after) >= 18
    want = spark.range(0, 4000).selectExpr("id as k", "if(id in (1010, 1015, 3999), 'new', concat('v', id)) as v")
    assert _rows(ingest.keyed_rows(spark, keyed)) == _rows(want)


def test_new_keys_are_appended(spark, keyed):
    before = _files(spark, keyed)
    new = spark.range(4000, 4100).selectExpr("id as k", "'more' as v")
    assert ingest.merge_into_keyed(spark, keyed, new) == {"rewritten": 0, "appended": 1, "kept": 19}
    assert before < _files(spark, keyed)
    assert ingest.keyed_rows(spark, keyed).count() == 4100


def test_merge_reads_only_its_ranges(spark, keyed):
    stored = spark.table(keyed).where(F.col(ingest.RANGE).isin([3, 4]))
    assert {f.split("/")[-2] for f in stored.inputFiles()} <= {f"{ingest.RANGE}={k}" for k in range(20)}
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [key_range" in plan


def test_merges_equal_the_plain_merge(spark):
    """A run of merges with repeated and null keys against merge_by_key on plain rows."""
    rng = random.Random(8)
    rows = [(rng.choice([None, *range(60)]), f"a{i}") for i in range(150)]
    name = ingest.create_keyed(spark.createDataFrame(rows, "k int, v string"), unique_name("keyed"), "k", 6)
    for turn in range(4):
        new = [(rng.choice([None, *range(40 * turn, 40 * turn + 30)]), f"b{turn}{i}") for i in range(rng.choice([0, 1, 25]))]
        ingest.merge_into_keyed(spark, name, spark.createDataFrame(new, "k int, v string"))
        keys = {k for k, _ in new if k is not None}
        rows = [r for r in rows if r[0] not in keys] + new
        assert _rows(ingest.keyed_rows(spark, name)) == sorted(rows, key=repr)


def test_empty_and_single_range(spark):
    empty = spark.createDataFrame([], "k long, v string")
    name = ingest.create_keyed(empty, unique_name("keyed"), "k", 5)
    ingest.merge_into_keyed(spark, name, empty)
    ingest.merge_into_keyed(spark, name, spark.createDataFrame([(1, "a")], "k long, v string"))
    assert _rows(ingest.keyed_rows(spark, name)) == [(1, "a")]


def _split_sizes(spark, df, key, m):
    path = scratch_path(spark, "splits")
    back = ingest.import_in_splits(df, path, key, m)
    assert back.drop("split").exceptAll(df).count() == 0 and back.count() == df.count()
    files = [f.split("/")[-2] for f in back.inputFiles()]
    assert len(files) == len(set(files))  # one file of each task
    return {r["split"]: r["count"] for r in back.groupBy("split").count().collect()}


@pytest.mark.parametrize("shape", ["even", "tail", "third at one", "two values", "dates"])
def test_splits_are_balanced(spark, shape):
    n = 30_000
    key = {
        "even": "id",
        "tail": "cast(pow(id, 3) / 1e6 as bigint)",
        "third at one": "if(id % 3 = 0, 7777, id)",
        "two values": "if(id % 5 = 0, 1, 2)",
        "dates": "date_add(date '2020-01-01', cast(sqrt(id) as int))",
    }[shape]
    df = spark.range(n).selectExpr("id", f"{key} as k").repartition(7)
    for m in (3, 8):
        sizes = _split_sizes(spark, df, "k", m)
        assert len(sizes) == m and max(sizes.values()) < 1.2 * n / m


def test_splits_of_odd_tables(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 3)], "k int, v int")
    assert sum(_split_sizes(spark, df, "k", 3).values()) == 3
    assert _split_sizes(spark, df.where("k > 5"), "k", 3) == {}
    assert _split_sizes(spark, df.where("k is null"), "k", 3) == {0: 2}
    assert _split_sizes(spark, df, "k", 1) == {0: 3}


def _last_write(spark):
    """The physical plan of the last write to files."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(k).physicalPlanDescription() for k in range(runs.size())]
    return [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p][-1]


def test_a_split_is_streamed_to_its_file(spark):
    conf = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)
    df = spark.range(3000).selectExpr("id", "id % 50 as k")
    _split_sizes(spark, df, "k", 3)
    plan = _last_write(spark)
    assert "Sort" not in plan and plan.count("Exchange") > 0  # no task holds its split to sort it
    assert spark.conf.get(conf) == before
