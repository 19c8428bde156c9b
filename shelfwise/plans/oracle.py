"""DuckDB SQL that computes the same result as each query key.

Column names and types are aligned with the Spark side: ranks and counts are
bigint, float sums are rounded to 2 places, ``cast(x as int)`` is written as
``cast(trunc(x) as int)`` because DuckDB rounds where Spark truncates, and
ascending window orders say ``nulls first`` as Spark does.
"""

from __future__ import annotations

_SALES = """
select cast(o_orderdate as date) as order_formatted_date,
       o_orderstatus as order_status,
       round(sum(l_extendedprice), 2) as total_amount,
       count(distinct o_orderkey) as total_orders
from orders join lineitem on o_orderkey = l_orderkey
group by 1, 2
"""

_DEPT_PRODUCTS = """
select r.r_regionkey as department_id, r.r_name as department_name,
       n.n_name as category_name, s.s_suppkey as product_id,
       s.s_name as product_name, s.s_acctbal as product_price,
       rank() over (partition by r.r_regionkey order by s.s_acctbal nulls first) as prod_rank,
       dense_rank() over (partition by r.r_regionkey order by s.s_acctbal nulls first) as prod_dense_rank
from supplier s
join nation n on s.s_nationkey = n.n_nationkey
join region r on n.n_regionkey = r.r_regionkey
"""

_CUSTOMER_COUNTS = """
select c.c_custkey as customer_id, c.c_name as customer_name,
       count(distinct l.l_partkey) as product_count
from customer c
join orders o on c.c_custkey = o.o_custkey
join lineitem l on o.o_orderkey = l.l_orderkey
group by 1, 2
"""

_TOP10 = _CUSTOMER_COUNTS + " order by product_count desc, customer_id limit 10"

ANALYTICS_SQL = {
    "orders_by_date_status": _SALES
    + " order by order_formatted_date desc, order_status, total_amount desc, total_orders desc",
    "top_date_status": _SALES
    + " order by total_orders desc, total_amount desc, order_formatted_date desc, order_status limit 1",
    "join_orders_items": """
        select o_orderkey, o_orderdate, o_custkey, o_orderstatus, l_partkey, l_extendedprice
        from orders join lineitem on o_orderkey = l_orderkey""",
    "category_price_stats": """
        select p_type as category, max(p_retailprice) as max_price,
               count(distinct p_partkey) as product_count,
               round(avg(p_retailprice), 2) as avg_price, min(p_retailprice) as min_price
        from part where p_retailprice < 950 group by p_type""",
    "category_sums": """
        select p_type as category, round(sum(p_retailprice), 2) as sum_price,
               cast(sum(p_size) as bigint) as sum_quantity
        from part group by p_type""",
    "distinct_then_count": """
        select category, count(*) as distinct_count
        from (select distinct p_type as category, p_brand from part) group by category""",
    "bids_per_auction": "select o_custkey as auction_id, count(*) as n from orders group by o_custkey",
    "bids_per_auction_stats": """
        select max(n) as max_count, min(n) as min_count, avg(n) as avg_count
        from (select count(*) as n from orders group by o_custkey)""",
    "busiest_day_orders": """
        select o_orderkey, o_custkey, o_orderstatus, o_orderdate,
               cast(o_orderdate as date) as order_day
        from orders
        where cast(o_orderdate as date) in (
            select d from (select cast(o_orderdate as date) as d, count(1) as c
                           from orders group by 1 order by c desc, d desc limit 1))""",
    "price_rank": _DEPT_PRODUCTS,
    "price_rank_cheap": f"select * from ({_DEPT_PRODUCTS}) where product_price < 5000",
    "top10_customers": _TOP10,
    "customer_products": _CUSTOMER_COUNTS + " order by product_count desc, customer_id",
    "distinct_products_top10": f"""
        with top as ({_TOP10})
        select distinct p.*
        from part p
        join lineitem l on l.l_partkey = p.p_partkey
        join orders o on o.o_orderkey = l.l_orderkey
        join top t on o.o_custkey = t.customer_id
        where p.p_retailprice < 950""",
    "cast_price_float": """
        select p_partkey, cast(cast(p_retailprice as varchar) as float) as price_num
        from part where cast(cast(p_retailprice as varchar) as float) > 950""",
    "cast_price_int": """
        select p_partkey, cast(trunc(cast(cast(p_retailprice as varchar) as double)) as integer) as price_int
        from part where cast(cast(p_retailprice as varchar) as double) > 950""",
    "filter_sort_desc": """
        select p_partkey, p_retailprice from part where p_retailprice > 950
        order by p_retailprice desc""",
    "limit_rows": "select * from orders order by o_orderkey limit 10",
    "month_key": """
        select strftime(o_orderdate, '%Y-%m') as order_month, count(*) as n_orders
        from orders group by 1""",
    "parse_date": "select event_id, cast(ts as date) as event_date from events",
    "parse_epoch": """
        select event_id, case when event_id % 11 <> 0 then cast(epoch(cast(cast(ts as date) as timestamp)) as bigint) end as day_epoch
        from events""",
    "timestamp_text_to_date": """
        select event_id, case when event_id % 7 <> 0 then cast(ts as date) end as event_date from events""",
    "epoch_month": "select strftime(ts, '%Y-%m') as event_month, count(*) as n_events from events group by 1",
    "epoch_ms_to_date": "select event_id, cast(ts as date) as event_date from events",
    "epoch_s_to_string": """
        select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as event_time from events""",
    "empty_to_null": """
        select event_id,
               nullif(case when event_type = 'error' then '' else event_type end, '') as event_type,
               props
        from events""",
}
