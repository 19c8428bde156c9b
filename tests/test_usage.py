"""The README's usage example, run on the test tables renamed to the
retail schema (orders / order_items / products)."""

from pyspark.sql import functions as F

from shelfwise.functions import dates
from shelfwise.operators import aggregates as agg, ingest
from shelfwise.operators.ranking import rank_within

from conftest import SF01


def test_readme_usage(spark):
    read = lambda n: spark.read.parquet(f"{SF01}/{n}.parquet")
    orders = read("orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
    )
    items = read("lineitem").select(
        F.col("l_orderkey").alias("order_item_order_id"),
        F.col("l_extendedprice").alias("order_item_subtotal"),
    )
    sales = agg.sales_by_day_status(
        orders, items, order_key="order_id", item_order_key="order_item_order_id",
        order_day=dates.epoch_ms_to_date("order_date"), status="order_status",
        amount="order_item_subtotal")
    report = agg.order_sales_report(sales)
    assert report.columns == ["order_formatted_date", "order_status", "total_amount", "total_orders"]
    with_items = orders.join(items, orders.order_id == items.order_item_order_id, "left_semi")
    assert report.agg(F.sum("total_orders")).first()[0] == with_items.count()

    products = read("part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_id"),
        F.col("p_retailprice").alias("product_price"), F.col("p_size").alias("department_id"))
    stats = agg.category_price_stats(products, category="product_category_id",
                                     price="product_price", product_id="product_id", price_below=950)
    assert stats.count() == products.select("product_category_id").distinct().count()

    ranked = rank_within(products, ["department_id"], "product_price",
                         rank_col="prod_rank", dense_rank_col="prod_dense_rank")
    assert ranked.where("prod_rank = 1").select("department_id").distinct().count() == \
        products.select("department_id").distinct().count()

    old = products.where("product_id <= 1111")
    new = products.where("product_id > 1000").withColumn("product_price", F.col("product_price") + 1)
    assert ingest.merge_by_key(old, new, "product_id").count() == products.count()
