"""Catalog-table query keys bound to the test tables.

Table names are unique per call and the tables are left in place: the
returned DataFrames are lazy and read them when the caller runs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.plans import analytics
from shelfwise.session import scratch_path, session_conf, unique_name
from shelfwise.sources import catalog, sequence
from shelfwise.sources.formats import CSV_QUOTING, escape, map_strings, unescape, write_as
from shelfwise.sources.tables import Tables

# Two literal rows for ``part`` (p_partkey, p_name, p_brand, p_type, p_size,
# p_retailprice); the second carries a null.
LITERAL_ROWS_SQL = (
    "(900001, 'garden hose', 'Brand#01', 'STANDARD RUBBER', 12, 24.5), "
    "(900002, 'paper lamp', 'Brand#02', 'PROMO PAPER', NULL, 7.25)"
)
STATIC_PARTITION_VALUE = "21"
MIN_BUCKETS = 4
EXCHANGE_BUCKETS = 40
LOOKUP_CUSTOMER = 899
LOOKUP_DAY = "1995-06-17"


def ddl_load_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited file with a header -> managed ``USING csv`` table -> load."""
    part = Tables(spark, sf_dir).part
    landing = scratch_path(spark, "landing-part-text")
    # Line breaks and backslashes are escaped, so files stay splittable; the
    # escapes are undone where the table is read.
    write_as(map_strings(part, escape), landing, "csv", "none", sep="|", header="true", **CSV_QUOTING)
    name = unique_name("part_text")
    catalog.create_table(
        spark, name, part.schema, using="csv", options={"sep": "|", "header": "true"} | CSV_QUOTING,
        comment="pipe-delimited part",
    )
    catalog.load_delimited(spark, name, landing, sep="|", header=True, overwrite=True, **CSV_QUOTING)
    return map_strings(spark.table(name), unescape)


def ddl_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External table at a location; DROP TABLE removes only the metadata."""
    supplier = Tables(spark, sf_dir).supplier
    location = scratch_path(spark, "external-supplier")
    name = unique_name("supplier_ext")
    catalog.create_table(spark, name, supplier.schema, using="parquet", location=location)
    supplier.write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(location)


def _cheap_ranked(spark, sf_dir) -> DataFrame:
    return analytics.price_rank_cheap(spark, sf_dir)


def ddl_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = unique_name("prod_less")
    _cheap_ranked(spark, sf_dir).createOrReplaceTempView(view)
    name = unique_name("prod_price_less")
    spark.sql(f"CREATE TABLE {name} USING parquet AS SELECT * FROM {view}")
    return spark.table(name)


def ddl_save_as_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = unique_name("prod_saved")
    _cheap_ranked(spark, sf_dir).write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def _part_table(spark, sf_dir) -> str:
    name = unique_name("products")
    Tables(spark, sf_dir).part.write.saveAsTable(name)
    return name


def ddl_like_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE TABLE b LIKE a; INSERT INTO b SELECT; INSERT OVERWRITE b SELECT."""
    src = _part_table(spark, sf_dir)
    name = unique_name("products_replica")
    spark.sql(f"CREATE TABLE {name} LIKE {src}")
    spark.sql(f"INSERT INTO TABLE {name} SELECT * FROM {src}")
    spark.sql(f"INSERT OVERWRITE TABLE {name} SELECT * FROM {src}")
    return spark.table(name)


def ddl_insert_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _part_table(spark, sf_dir)
    spark.sql(f"INSERT INTO {name} VALUES {LITERAL_ROWS_SQL}")
    return spark.table(name)


def ddl_alter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add a nullable column in place; move and retype a column by rewrite
    (``ALTER ... CHANGE ... AFTER`` is not supported on session-catalog
    tables)."""
    name = _part_table(spark, sf_dir)
    spark.sql(f"ALTER TABLE {name} ADD COLUMNS (p_comment string)")
    evolved = unique_name("products_v2")
    spark.table(name).select(
        "p_name",
        F.col("p_partkey").cast("bigint").alias("p_partkey"),
        "p_brand",
        "p_type",
        F.col("p_size").cast("bigint").alias("p_size"),
        "p_retailprice",
        "p_comment",
    ).write.saveAsTable(evolved)
    return spark.table(evolved)


def ddl_multi_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of the source feeds two tables (Spark's ``FROM src INSERT ...
    INSERT ...`` would scan it once per target)."""
    orders = Tables(spark, sf_dir).orders
    done = F.col("o_orderstatus") == "F"
    names = {t: unique_name(f"orders_{t}") for t in ("done", "open")}
    catalog.multi_insert(orders, scratch_path(spark, "orders-split"), {names["done"]: done, names["open"]: ~F.coalesce(done, F.lit(False))})
    parts = [spark.table(table).withColumn("target", F.lit(target)) for target, table in names.items()]
    return parts[0].unionByName(parts[1])


def _orders_by_month(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("order_customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.date_format("o_orderdate", "yyyy-MM").alias("order_month"),
    )


def ddl_dynamic_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly dynamic partitions, then an overwrite of the earliest month by
    its first order only; the other months are kept."""
    rows = _orders_by_month(Tables(spark, sf_dir).orders)
    name = unique_name("orders_part")
    catalog.create_table(spark, name, rows.schema, using="parquet", partitioned_by=["order_month"])
    catalog.overwrite_partitions(catalog.spread_for_partitioned_write(rows, ["order_month"]), name)
    # The earliest month comes from the table's partition names, its rows from that partition alone.
    months = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    first_month = min((m for m in months if m != "__HIVE_DEFAULT_PARTITION__"), default=None)
    if first_month is None:
        return spark.table(name)
    replacement = spark.table(name).where(F.col("order_month") == first_month).orderBy("order_id").limit(1).select(*rows.columns)
    catalog.overwrite_partitions(replacement, name)
    return spark.table(name)


def _bids_by_year(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("bid_id"),
        F.col("o_custkey").alias("auction_id"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.year("o_orderdate").cast("decimal(10,0)").alias("bid_year"),
    )


def _text_view(spark: SparkSession, path: str, columns: str, **options: str) -> str:
    """A temporary table over CSV files with declared types (``CREATE TEMPORARY
    VIEW ... USING csv``, no copy), and the view over it that undoes the escapes."""
    raw, view = unique_name("temp_text"), unique_name("temp_rows")
    given = catalog.sql_options({"path": path} | options | CSV_QUOTING)
    spark.sql(f"CREATE TEMPORARY VIEW {raw} ({columns}) USING csv OPTIONS ({given})")
    map_strings(spark.table(raw), unescape).createOrReplaceTempView(view)
    return view


def ddl_decimal_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bids land as a comma-delimited file and are read through a temporary
    table (``CREATE TEMPORARY VIEW ... USING csv``, declared column types,
    no copy).  A table partitioned by a ``decimal(10,0)`` column is filled by
    a dynamic-partition ``INSERT INTO ... SELECT ..., key`` (partition column
    last) and rewritten by ``INSERT OVERWRITE`` of the same rows, which
    replaces the partitions it writes: every row is held once.

    Bids map to orders.  The partition value is the year of the bid, a
    bounded domain; one directory per auction id would grow with the data.
    The ``REBALANCE`` hint lets AQE size the writer tasks per partition
    value, so a year holding a third of the rows is written by many tasks.
    """
    bids = _bids_by_year(Tables(spark, sf_dir).orders)
    landing = scratch_path(spark, "landing-bids")
    write_as(map_strings(bids, escape), landing, "csv", "none", sep=",", **CSV_QUOTING)
    view = _text_view(spark, landing, catalog.ddl_columns(bids.schema), sep=",")
    name = unique_name("bids_by_year")
    catalog.create_table(spark, name, bids.schema, using="parquet", partitioned_by=["bid_year"])
    select = (
        "SELECT /*+ REBALANCE(bid_year) */ bid_id, auction_id, price, status, bid_year "
        f"FROM {view}"
    )
    spark.sql(f"INSERT INTO {name} PARTITION (bid_year) {select}")
    with session_conf(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (bid_year) {select}")
    return spark.table(name)


def ddl_decimal_partition_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table stored as SequenceFile: a folder per decimal year, the
    year read back from the folder's name."""
    bids = _bids_by_year(Tables(spark, sf_dir).orders)
    path = scratch_path(spark, "bids-by-year-sequence")
    sequence.write_sequence_partitions(bids, path, "bid_year")
    return sequence.read_sequence_partitions(spark, path, bids.schema, "bid_year")


def ddl_static_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT INTO t PARTITION (load_day='21') SELECT ..."""
    orders = Tables(spark, sf_dir).orders
    src = unique_name("orders_src")
    orders.createOrReplaceTempView(src)
    name = unique_name("orders_static")
    spark.sql(
        f"CREATE TABLE {name} (o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
        f"load_day string) USING parquet PARTITIONED BY (load_day)"
    )
    spark.sql(
        f"INSERT INTO {name} PARTITION (load_day = '{STATIC_PARTITION_VALUE}') "
        f"SELECT o_orderkey, o_custkey, o_orderstatus FROM {src}"
    )
    return spark.table(name)


def ddl_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides bucketed on the order key: the join reads matching buckets
    with no exchange; then lines, orders and amount per status."""
    t = Tables(spark, sf_dir)
    o_name, l_name = unique_name("orders_bkt"), unique_name("lineitem_bkt")
    orders = t.orders.select("o_orderkey", "o_orderstatus")
    items = t.lineitem.select("l_orderkey", "l_extendedprice")
    # One bucket count for both sides (from the rows of both), so the join
    # pairs bucket i with bucket i.
    n = catalog.bucket_count(orders, items, minimum=MIN_BUCKETS)
    catalog.save_bucketed(orders, o_name, "o_orderkey", n)
    catalog.save_bucketed(items, l_name, "l_orderkey", n)
    o, li = spark.table(o_name), spark.table(l_name)
    joined = o.join(li, o.o_orderkey == li.l_orderkey)
    return joined.groupBy(F.col("o_orderstatus").alias("order_status")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_distinct("o_orderkey").alias("n_orders"),
        F.round(F.sum("l_extendedprice"), 2).alias("total_amount"),
    )


def ddl_bucketed_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers bucketed on their nation, a key of few values that each fill more
    than a bucket: heavy keys are salted, and the join with the nations still
    needs no exchange."""
    t = Tables(spark, sf_dir)
    c_name, n_name = unique_name("customer_salted"), unique_name("nation_salted")
    customers = t.customer.select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("nation_key"))
    nations = t.nation.select(F.col("n_nationkey").alias("nation_key"), "n_name")
    catalog.save_bucketed_pair(customers, nations, c_name, n_name, "nation_key", catalog.bucket_count(customers, minimum=EXCHANGE_BUCKETS))
    joined = catalog.join_bucketed_pair(spark, c_name, n_name, "nation_key")
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("n_customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


def ddl_temp_view_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-delimited file with a header -> temporary view over it (no copy)
    -> ``FROM view INSERT OVERWRITE TABLE`` into a table clustered by the
    exchange and symbol into 40 buckets (there are only a few exchanges, and
    one of them alone would be one bucket).  ``events`` stands in for the daily
    quotes: exchange = event_type, symbol = user id, volume = event id."""
    quotes = Tables(spark, sf_dir).events.select(
        F.col("event_type").alias("exchang"),
        F.col("user_id").cast("string").alias("symbo"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("value").alias("close"),
        F.col("event_id").alias("volume"),
    )
    # The view reads text as strings; the varchar lengths are enforced when
    # the rows are written into the bucketed table.
    landing = scratch_path(spark, "landing-quotes")
    write_as(map_strings(quotes, escape), landing, "csv", "none", sep="\t", header="true", **CSV_QUOTING)
    view = _text_view(spark, landing, "exchang string, symbo string, date string, close double, volume bigint", sep="\t", header="true")
    name = unique_name("quotes_bucketed")
    spark.sql(
        f"CREATE TABLE {name} (exchang varchar(20), symbo varchar(10), date string, "
        f"close double, volume bigint) USING parquet "
        f"CLUSTERED BY (exchang, symbo) INTO {EXCHANGE_BUCKETS} BUCKETS"
    )
    spark.sql(f"FROM {view} INSERT OVERWRITE TABLE {name} SELECT *")
    return spark.table(name)


def lookup_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    path = scratch_path(spark, "orders-by-customer")
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    catalog.write_lookup_layout(orders, path, "o_custkey", files, spread_by=["o_orderkey"])
    return spark.read.parquet(path).where(F.col("o_custkey") == F.lit(LOOKUP_CUSTOMER))


def lookup_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A look-up on a column the files are not sorted by: orders laid out by
    customer, looked up by day through bitmaps of the files that hold each day."""
    orders = Tables(spark, sf_dir).orders.withColumn("order_day", F.to_date("o_orderdate"))
    path, manifest = scratch_path(spark, "orders-by-customer"), scratch_path(spark, "orders-manifest")
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    catalog.write_lookup_layout(orders, path, "o_custkey", files, spread_by=["o_orderkey"])
    catalog.write_value_manifest(spark, path, manifest, "order_day")
    day = F.lit(LOOKUP_DAY).cast("date")
    named = catalog.files_with(spark, manifest, LOOKUP_DAY)
    found = spark.read.schema(orders.schema).parquet(*named) if named else orders.where("false")
    return found.where(F.col("order_day") == day)


QUERIES = {
    "ddl_load_text": ddl_load_text,
    "ddl_external": ddl_external,
    "ddl_ctas": ddl_ctas,
    "ddl_save_as_table": ddl_save_as_table,
    "ddl_like_insert": ddl_like_insert,
    "ddl_insert_values": ddl_insert_values,
    "ddl_alter": ddl_alter,
    "ddl_multi_insert": ddl_multi_insert,
    "ddl_dynamic_partition": ddl_dynamic_partition,
    "ddl_decimal_partition": ddl_decimal_partition,
    "ddl_decimal_partition_sequence": ddl_decimal_partition_sequence,
    "ddl_static_partition": ddl_static_partition,
    "ddl_bucketed": ddl_bucketed,
    "ddl_bucketed_skewed": ddl_bucketed_skewed,
    "ddl_temp_view_bucketed": ddl_temp_view_bucketed,
    "lookup_layout": lookup_layout,
    "lookup_manifest": lookup_manifest,
}

_BY_MONTH = """
    select o_orderkey as order_id, cast(o_orderdate as date) as order_date,
           o_custkey as order_customer_id, o_orderstatus as order_status,
           strftime(o_orderdate, '%Y-%m') as order_month
    from orders"""

_BIDS = """
        select o_orderkey as bid_id, o_custkey as auction_id, o_totalprice as price,
               o_orderstatus as status, cast(year(o_orderdate) as decimal(10,0)) as bid_year
        from orders"""

ORACLE_SQL = {
    "ddl_load_text": "select * from part",
    "ddl_external": "select * from supplier",
    "ddl_like_insert": "select * from part",
    "ddl_insert_values": f"""
        select * from part
        union all select * from (values {LITERAL_ROWS_SQL})
            as v(p_partkey, p_name, p_brand, p_type, p_size, p_retailprice)""",
    "ddl_alter": """
        select p_name, p_partkey, p_brand, p_type, cast(p_size as bigint) as p_size,
               p_retailprice, cast(null as varchar) as p_comment
        from part""",
    "ddl_multi_insert": """
        select *, case when o_orderstatus = 'F' then 'done' else 'open' end as target
        from orders""",
    "ddl_dynamic_partition": f"""
        with m as ({_BY_MONTH})
        select * from m where order_month <> (select min(order_month) from m)
        union all
        select * from (select * from m where order_month = (select min(order_month) from m)
                       order by order_id limit 1)""",
    "ddl_decimal_partition": _BIDS,
    "ddl_decimal_partition_sequence": _BIDS,
    "ddl_static_partition": f"""
        select o_orderkey, o_custkey, o_orderstatus, '{STATIC_PARTITION_VALUE}' as load_day
        from orders""",
    "ddl_bucketed": """
        select o_orderstatus as order_status, count(*) as n_lines,
               count(distinct o_orderkey) as n_orders, round(sum(l_extendedprice), 2) as total_amount
        from orders join lineitem on o_orderkey = l_orderkey group by o_orderstatus""",
    "ddl_bucketed_skewed": """
        select n_name, count(*) as n_customers, round(sum(c_acctbal), 2) as balance
        from customer join nation on c_nationkey = n_nationkey group by n_name""",
    "ddl_temp_view_bucketed": """
        select event_type as exchang, cast(user_id as varchar) as symbo,
               strftime(ts, '%Y-%m-%d') as date, value as close, event_id as volume
        from events""",
    "lookup_manifest": f"select *, cast(o_orderdate as date) as order_day from orders where cast(o_orderdate as date) = date '{LOOKUP_DAY}'",
    "lookup_layout": f"select * from orders where o_custkey = {LOOKUP_CUSTOMER}",
}
