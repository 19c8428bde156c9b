"""Sorted results come back sorted."""

import pytest

from shelfwise.plans.registry import query_registry

from conftest import SF01


def _collected(spark, key):
    return query_registry()[key](spark, SF01).collect()


@pytest.mark.parametrize(
    "key, order",
    [
        ("orders_by_date_status", None),
        ("filter_sort_desc", lambda r: (-r.p_retailprice, r.p_partkey)),
        ("price_rank", lambda r: (r.department_id, -r.prod_rank, r.product_id)),
        ("customer_products", lambda r: (-r.product_count, r.customer_id)),
        ("limit_rows", lambda r: r.o_orderkey),
    ],
)
def test_sorted(spark, key, order):
    rows = _collected(spark, key)
    assert len(rows) > 1
    if order is None:  # latest day first, then status, amount down, orders
        order = lambda r: (-r.order_formatted_date.toordinal(), r.order_status, -r.total_amount, r.total_orders)
    assert rows == sorted(rows, key=order)
