"""Multi-insert into lasting tables, saved imports that remember a column, verified imports."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import ingest
from shelfwise.session import scratch_path, unique_name
from shelfwise.sources import catalog
from shelfwise.streaming.incremental import read_remembered, run_remembered

from conftest import SF001


def _ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_targets_outlive_the_session_that_filled_them(spark):
    source = spark.range(100).withColumn("target", F.lit("own column"))
    a, b, c = (unique_name(f"multi_{k}") for k in "abc")
    other = spark.newSession()
    catalog.multi_insert(source, scratch_path(spark, "multi"), {a: F.col("id") < 10, b: F.col("id") % 2 == 0, c: F.col("id") > 1000})
    assert _ids(other.table(a)) == list(range(10))
    assert _ids(other.table(b)) == list(range(0, 100, 2))  # a row may go to several targets
    assert _ids(other.table(c)) == []
    assert other.table(a).columns == ["id", "target"] and catalog.table_is_external(spark, a)
    catalog.multi_insert(source, scratch_path(spark, "multi"), {a: F.col("id") == 5, c: F.col("id") > 97})
    assert _ids(spark.table(a)) == [5] and _ids(spark.table(c)) == [98, 99] and len(_ids(spark.table(b))) == 50
    spark.sql(f"DROP TABLE {a}")
    assert _ids(spark.table(b)) == list(range(0, 100, 2))


def test_one_scan_of_the_source(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(50, numPartitions=1).mapInArrow(count, "id long")
    catalog.multi_insert(source, scratch_path(spark, "multi"), {unique_name("multi"): F.col("id") < 30, unique_name("multi"): F.col("id") >= 30})
    assert seen.value == 50


def test_a_slice_delivered_twice(spark):
    landing, target, state = (scratch_path(spark, f"saved-{k}") for k in ("landing", "target", "state"))
    rows = spark.range(60).selectExpr("id", "concat('v', id) as v")

    def land(where):
        rows.where(where).write.mode("append").parquet(landing)

    def run():
        return run_remembered(spark.read.schema(rows.schema).parquet(landing), target, state, "id")

    land("id < 20")
    assert run() == 1
    land("id < 20")
    land("id >= 20 and id < 40")
    land("id >= 30 and id < 40")  # twice within one run
    assert run() == 2
    assert run() == 3  # nothing new
    assert _ids(read_remembered(spark, target, rows.schema)) == list(range(40))
    land("id >= 10")
    assert run() == 4
    assert _ids(read_remembered(spark, target, rows.schema)) == list(range(60))


def test_a_run_lost_half_way_is_done_again(spark):
    landing, target, state = (scratch_path(spark, f"lost-{k}") for k in ("landing", "target", "state"))
    rows = spark.range(10)
    rows.write.parquet(landing)
    source = spark.read.schema(rows.schema).parquet(landing)
    spark.range(4).write.parquet(f"{target}/run=0")  # rows written, value not remembered
    run_remembered(source, target, state, "id")
    assert _ids(read_remembered(spark, target, rows.schema)) == list(range(10))


def test_runs_without_rows(spark):
    target, state = scratch_path(spark, "none-target"), scratch_path(spark, "none-state")
    empty = spark.range(0)
    run_remembered(empty, target, state, "id")
    run_remembered(spark.range(3), target, state, "id")
    run_remembered(empty, target, state, "id")
    run_remembered(spark.range(5), target, state, "id")
    assert _ids(read_remembered(spark, target, empty.schema)) == [0, 1, 2, 3, 4]


@pytest.fixture
def part(spark):
    return spark.read.parquet(f"{SF001}/part.parquet")


def _figures(df):
    return df.agg(*ingest.content_hash(df)).first()


def test_content_hash_sees_every_change(spark, part):
    base = _figures(part)
    assert _figures(part.repartition(7).orderBy(F.rand(3))) == base
    first = part.agg(F.min("p_partkey")).first()[0]
    at = F.col("p_partkey") == first
    changes = {
        "value": part.withColumn("p_size", F.when(at, F.col("p_size") + 1).otherwise(F.col("p_size"))),
        "letters of equal length": part.withColumn("p_name", F.when(at, F.reverse("p_name")).otherwise(F.col("p_name"))),
        "columns swapped": part.withColumns({"p_brand": F.when(at, F.col("p_type")).otherwise(F.col("p_brand")), "p_type": F.when(at, F.col("p_brand")).otherwise(F.col("p_type"))}),
        "null for a value": part.withColumn("p_brand", F.when(~at, F.col("p_brand"))),
        "null for its mark": part.withColumn("p_brand", F.when(at, F.lit("\\N")).otherwise(F.col("p_brand"))),
        "row twice": part.unionByName(part.where(at)),
        "two rows twice": part.unionByName(part.where(at)).unionByName(part.where(at)),
        "row missing": part.where(~at),
        "row for another": part.where(~at).unionByName(part.where(F.col("p_partkey") == first + 1)),
    }
    for name, df in changes.items():
        assert _figures(df) != base, name
    assert len({_figures(df) for df in changes.values()}) == len(changes)


def test_import_verified_tells_a_broken_copy(spark, part, monkeypatch):
    monkeypatch.setattr(ingest, "convert", lambda df, path, fmt, codec: df.withColumn("p_size", F.lit(1)) if path == "bad" else df)
    report = ingest.import_verified({"good": part, "bad": part}, lambda name: name)
    assert {(r.table_name, r.same) for r in report.collect()} == {("good", True), ("bad", False)}
