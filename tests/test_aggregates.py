"""products_bought_by, with and without broadcasts, gives the rows of the
plain SQL formulation and runs nothing while it is planned."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import aggregates as agg
from shelfwise.session import session_conf

from conftest import SF01


def _tables(spark):
    read = lambda n: spark.read.parquet(f"{SF01}/{n}.parquet")
    return read("part"), read("orders"), read("lineitem")


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_hot_buyer(spark, threshold):
    part, orders, lineitem = _tables(spark)
    # Ten buyers, one of them holding a third of all orders.
    third = orders.agg(F.max("o_orderkey")).first()[0] // 3
    hot = orders.withColumn(
        "o_custkey", F.when(F.col("o_orderkey") <= third, F.lit(7)).otherwise(F.col("o_custkey"))
    )
    buyers = hot.select(F.col("o_custkey").alias("customer_id")).distinct().orderBy("customer_id").limit(10)
    tracker = spark.sparkContext.statusTracker()
    jobs = set(tracker.getJobIdsForGroup(None))
    got = agg.products_bought_by(
        part, hot, lineitem, buyers,
        order_key="o_orderkey", order_customer="o_custkey",
        item_order_key="l_orderkey", item_product="l_partkey",
        product_id="p_partkey", price="p_retailprice", price_below=950.0,
    )
    assert set(tracker.getJobIdsForGroup(None)) == jobs
    want = _expected_hot(spark, part, hot, lineitem, buyers)
    with session_conf(spark, spark__sql__autoBroadcastJoinThreshold=threshold):
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _expected_hot(spark, part, orders, lineitem, buyers):
    for name, df in (("p", part), ("o", orders), ("l", lineitem), ("b", buyers)):
        df.createOrReplaceTempView(f"pbh_{name}")
    return spark.sql(
        "select distinct p.* from pbh_p p join pbh_l l on p.p_partkey = l.l_partkey "
        "join pbh_o o on l.l_orderkey = o.o_orderkey join pbh_b b on o.o_custkey = b.customer_id "
        "where p.p_retailprice < 950"
    )
