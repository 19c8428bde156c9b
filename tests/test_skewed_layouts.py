"""Bucketed joins with heavy keys, and look-ups through bitmaps of files."""

import pytest
from pyspark.sql import functions as F

from shelfwise.session import scratch_path, unique_name
from shelfwise.sources import catalog


@pytest.fixture
def hot(spark):
    """A third of the rows on one key, a null key, many light keys."""
    return spark.range(30_000).selectExpr("case when id % 3 = 0 then 7 when id % 1000 = 1 then null else id end as k", "id as v")


def test_heavy_keys(spark, hot):
    assert catalog.heavy_keys(hot, "k", 0.1) == {7: (10_001, 30_000)}
    assert catalog.heavy_keys(hot.where("k <> 7"), "k", 0.1) == {}
    assert catalog.heavy_keys(hot.where("false"), "k", 0.1) == {}


def test_no_bucket_is_large_and_nothing_is_shuffled(spark, hot):
    n, a, b = 12, unique_name("skew_large"), unique_name("skew_small")
    small = spark.range(0, 30_000, 5).selectExpr("id + 2 as k", "id as w").unionByName(spark.createDataFrame([(7, -1), (None, -2)], "k long, w long"))
    heavy = catalog.save_bucketed_pair(hot, small, a, b, "k", n)
    assert set(heavy) == {7} and heavy[7] == 33
    sizes = [r["count"] for r in spark.table(a).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) == n and max(sizes) < 2 * sum(sizes) / n
    joined = catalog.join_bucketed_pair(spark, a, b, "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    want = hot.join(small, "k")
    assert joined.count() == want.count() > 10_000
    assert joined.exceptAll(want).count() == 0


def test_without_heavy_keys(spark):
    a, b = unique_name("even_large"), unique_name("even_small")
    rows = spark.range(1000).selectExpr("id as k", "id as v")
    assert catalog.save_bucketed_pair(rows, rows.withColumnRenamed("v", "w"), a, b, "k", 4) == {}
    assert catalog.join_bucketed_pair(spark, a, b, "k").where("v = w").count() == 1000


def test_lookup_opens_only_named_files(spark):
    path, manifest = scratch_path(spark, "by-key"), scratch_path(spark, "manifest")
    rows = spark.range(9000).selectExpr("id as k", "case when id < 100 then 'rare' when id % 7 = 0 then null else concat('v', id % 40) end as v")
    catalog.write_lookup_layout(rows, path, "k", 30)
    catalog.write_value_manifest(spark, path, manifest, "v")
    assert len(spark.read.parquet(path).inputFiles()) == 30
    named = catalog.files_with(spark, manifest, "rare")
    assert 1 <= len(named) <= 2 and catalog.files_with(spark, manifest, "none") == []
    assert spark.read.parquet(*named).where("v = 'rare'").count() == 100
    for value in ("v0", "v39"):
        holding = {r[0] for r in spark.read.parquet(path).where(F.col("v") == value).select("_metadata.file_path").distinct().collect()}
        assert set(catalog.files_with(spark, manifest, value)) == holding


def test_planned_bytes(spark):
    small, large = spark.range(10), spark.range(100_000)
    assert 0 < catalog.planned_bytes(small) < catalog.planned_bytes(large)


def test_buckets_follow_rows_not_compressed_bytes(spark):
    path, n = scratch_path(spark, "compressed"), 4_000_000
    spark.range(n).selectExpr("id div 1000 as k", "1.5D as v").write.parquet(path)
    rows = spark.read.parquet(path)
    assert catalog.buckets_for_bytes(catalog.planned_bytes(rows)) == 1  # so many rows in one small file
    buckets = catalog.bucket_count(rows)
    assert buckets >= 3 and catalog.sorted_bytes(rows) <= buckets * catalog.SORT_BYTES
    assert catalog.bucket_count(rows, rows) >= 2 * buckets - 1  # a task sorts a bucket of each
    assert catalog.sorted_bytes(rows.unionByName(rows)) == 2 * catalog.sorted_bytes(rows)
    assert catalog.bucket_count(rows.where("k < 0"), minimum=4) == 4
