"""All query keys and their oracle SQL, in one place."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.plans import analytics, conversions, imports, oracle, tables


def query_registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reg: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    reg.update(analytics.QUERIES)
    reg.update(conversions.QUERIES)
    reg.update(tables.QUERIES)
    reg.update(imports.QUERIES)
    return reg


def oracle_queries() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql.update(oracle.ANALYTICS_SQL)
    sql.update(conversions.ORACLE_SQL)
    sql.update(tables.ORACLE_SQL)
    sql.update(imports.ORACLE_SQL)
    for k in ("ddl_ctas", "ddl_save_as_table"):
        sql[k] = oracle.ANALYTICS_SQL["price_rank_cheap"]
    keys = query_registry()
    return {k: v for k, v in sql.items() if k in keys}
