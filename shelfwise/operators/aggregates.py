"""Grouped analytics: sales per day and status, price statistics per
category, counts per key, busiest day, products per customer.

Every function is DataFrame -> DataFrame with the table columns as
parameters.  Plans are written so that

* large inputs are reduced by a partial (map-side) aggregate before they are
  shuffled, so a key holding a third of all rows costs one row per map task
  in the shuffle, not a third of the data in one reducer;
* a later grouping reuses the hash partitioning of an earlier join or
  aggregate on a subset of its keys instead of shuffling again;
* only results bounded by construction (``limit k``) are broadcast without a
  size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.joins import semi_join_top


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Sales per (day, status)


def sales_by_day_status(
    orders: DataFrame,
    items: DataFrame,
    *,
    order_key: str,
    item_order_key: str,
    order_day: Column,
    status: str,
    amount: str,
) -> DataFrame:
    """Per (day, status): ``round(sum(amount), 2)`` and distinct orders.

    Equivalent to ``orders JOIN items GROUP BY day, status`` with
    ``round(sum(amount),2)`` and ``count(distinct order_key)``, but planned as

    1. items aggregated per order key (partial aggregate, then one shuffle on
       the key) -- the join input shrinks from one row per item to one per
       order;
    2. join with orders on the key; the aggregated side is already hash
       partitioned on it, so only ``orders`` is shuffled;
    3. group by (day, status, key): satisfied by the join's partitioning, no
       exchange.  This keeps ``count(distinct key)`` exact even if a key were
       repeated in ``orders``;
    4. group by (day, status): partial aggregate, tiny final shuffle.

    Output: ``order_formatted_date, order_status, total_amount, total_orders``.
    """
    per_order = items.groupBy(F.col(item_order_key).alias("_key")).agg(
        F.sum(amount).alias("_amount")
    )
    keyed_orders = orders.select(
        F.col(order_key).alias("_key"),
        order_day.alias("order_formatted_date"),
        F.col(status).alias("order_status"),
    )
    joined = keyed_orders.join(per_order, "_key")
    per_key = joined.groupBy("order_formatted_date", "order_status", "_key").agg(
        F.sum("_amount").alias("_amount")
    )
    return per_key.groupBy("order_formatted_date", "order_status").agg(
        F.round(F.sum("_amount"), 2).alias("total_amount"),
        F.count("_key").alias("total_orders"),
    )


def order_sales_report(sales: DataFrame) -> DataFrame:
    """Sort as the report is read: newest day first, then status, then the
    largest amount and order count."""
    return sales.orderBy(
        F.col("order_formatted_date").desc(),
        F.col("order_status"),
        F.col("total_amount").desc(),
        F.col("total_orders").desc(),
    )


def top_day_status(sales: DataFrame, k: int = 1) -> DataFrame:
    """The (day, status) groups with most orders, then most revenue.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps its own top ``k`` and one task merges ``k x partitions`` rows.  Day
    and status break remaining ties so the answer is deterministic.
    """
    return sales.orderBy(
        F.col("total_orders").desc(),
        F.col("total_amount").desc(),
        F.col("order_formatted_date").desc(),
        F.col("order_status"),
    ).limit(k)


# --------------------------------------------------------------------------
# Product price statistics per category


def category_price_stats(
    products: DataFrame,
    *,
    category: str,
    price: str,
    product_id: str,
    price_below: float,
) -> DataFrame:
    """max, distinct product count, ``round(avg, 2)`` and min of the price
    per category, over products cheaper than ``price_below``.

    The filter reaches the parquet scan.  ``count_distinct`` with one distinct
    column plans without Expand: rows are first reduced to distinct
    (category, product) pairs -- shuffled on both columns, so one huge
    category is still spread over all reducers -- and only per-partition
    partial results are shuffled on the category.
    """
    return (
        products.where(F.col(price) < F.lit(price_below))
        .groupBy(F.col(category).alias("category"))
        .agg(
            F.max(price).alias("max_price"),
            F.count_distinct(product_id).alias("product_count"),
            F.round(F.avg(price), 2).alias("avg_price"),
            F.min(price).alias("min_price"),
        )
    )


def category_sums(products: DataFrame, *, category: str, price: str, quantity: str) -> DataFrame:
    """Two running sums per category (combine-by-key of a pair)."""
    return products.groupBy(F.col(category).alias("category")).agg(
        F.round(F.sum(price), 2).alias("sum_price"),
        F.sum(quantity).cast("bigint").alias("sum_quantity"),
    )


def distinct_then_count(df: DataFrame, *, key: str, value: str) -> DataFrame:
    """Number of distinct ``value`` per ``key`` (distinct pairs, then count).

    The distinct step shuffles on (key, value); the count shuffles only
    partial counts on ``key``.
    """
    return (
        df.select(F.col(key).alias("category"), F.col(value).alias("_v"))
        .distinct()
        .groupBy("category")
        .agg(F.count("_v").alias("distinct_count"))
    )


# --------------------------------------------------------------------------
# Counts per key


def count_per_key(df: DataFrame, key: str, out_key: str | None = None) -> DataFrame:
    """``select key, count(*) group by key`` (bids per auction)."""
    return df.groupBy(F.col(key).alias(out_key or key)).agg(F.count(F.lit(1)).alias("n"))


def count_stats(counts: DataFrame, count_col: str = "n") -> DataFrame:
    """max / min / avg of a count column: an aggregate of an aggregate.

    The global aggregate is partial per partition, so the single final task
    merges one row per partition.
    """
    return counts.agg(
        F.max(count_col).alias("max_count"),
        F.min(count_col).alias("min_count"),
        F.avg(count_col).alias("avg_count"),
    )


def busiest_day_rows(df: DataFrame, day: Column, day_name: str = "order_day") -> DataFrame:
    """All rows of the day with the most rows (ties -> latest day).

    ``where day in (select day ... order by count desc, day desc limit 1)``:
    the one-row subquery is broadcast and the semi join is applied while
    scanning ``df`` -- no shuffle of ``df`` at all beyond the count's partial
    aggregate.
    """
    with_day = df.withColumn(day_name, day)
    best = (
        with_day.groupBy(day_name)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.col("_n").desc(), F.col(day_name).desc())
        .limit(1)
        .select(day_name)
    )
    return semi_join_top(with_day, best, day_name)


# --------------------------------------------------------------------------
# Products per customer


def customer_product_pairs(
    orders: DataFrame,
    items: DataFrame,
    *,
    order_key: str,
    order_customer: str,
    item_order_key: str,
    item_product: str,
) -> DataFrame:
    """Distinct (customer_id, product_id) pairs bought (items x orders).

    The join is on the order key; the distinct is a partial aggregate per
    task, then one shuffle on (customer, product) -- balanced even when one
    customer placed a third of all orders.
    """
    return (
        items.select(F.col(item_order_key).alias("_order"), F.col(item_product).alias("product_id"))
        .join(
            orders.select(F.col(order_key).alias("_order"), F.col(order_customer).alias("customer_id")),
            "_order",
        )
        .select("customer_id", "product_id")
        .distinct()
    )


def customer_product_counts(pairs: DataFrame, customers: DataFrame, *, customer_id: str, customer_name: str) -> DataFrame:
    """Distinct products per customer with the customer's name.

    Counting the distinct pairs per customer shuffles only partial counts;
    the result is hash partitioned on the customer key, so the name join
    shuffles only the customer table.  Output: ``customer_id, customer_name,
    product_count``.
    """
    counts = pairs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("product_count"))
    names = customers.select(
        F.col(customer_id).alias("customer_id"), F.col(customer_name).alias("customer_name")
    )
    # dropDuplicates keeps ``group by id, name`` semantics if a customer row is
    # repeated; it groups on the join key plus more, so it needs no exchange.
    return counts.join(names, "customer_id").dropDuplicates(
        ["customer_id", "customer_name", "product_count"]
    ).select("customer_id", "customer_name", "product_count")


def top_customers(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` by product count, customer id breaking ties."""
    return counts.orderBy(F.col("product_count").desc(), F.col("customer_id")).limit(k)


def products_bought_by(
    products: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    buyers: DataFrame,
    *,
    order_key: str,
    order_customer: str,
    item_order_key: str,
    item_product: str,
    product_id: str,
    price: str,
    price_below: float,
) -> DataFrame:
    """``select distinct p.* from products p join items join orders join
    buyers where price < price_below``.

    One lazy plan.  ``buyers`` is a top-k result, so its few ids are broadcast
    and the semi join keeps only the buyers' orders while orders are scanned.
    The lines are semi-joined to those orders; whether they are broadcast is
    Spark's decision from their measured size, and a buyer holding a third of
    all orders gets the shuffle join.  Semi joins never multiply rows, and the
    product ids are made distinct before the last one.
    """
    wanted = buyers.select(F.col("customer_id").alias(order_customer))
    their_orders = semi_join_top(orders.select(order_key, order_customer), wanted, order_customer)
    lines = items.select(F.col(item_order_key).alias(order_key), F.col(item_product).alias(product_id))
    bought = lines.join(their_orders, order_key, "left_semi").select(product_id).distinct()
    cheap = products.where(F.col(price) < F.lit(price_below))
    return cheap.join(bought, product_id, "left_semi").distinct()
