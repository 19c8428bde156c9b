"""Each analytic in its DataFrame form (the registered query) against its SQL
form run by Spark SQL on views of the same tables, compared with exceptAll
both ways -- the reference's habit of solving one problem several ways,
made automatic.  Keys whose SQL uses DuckDB-only syntax are skipped here;
the DuckDB oracle covers them."""

import pytest
from pyspark.sql import functions as F

from shelfwise.plans import analytics
from shelfwise.plans.registry import oracle_queries
from shelfwise.sources.tables import Tables

from conftest import SF01

# The oracle SQL of these keys uses DuckDB functions (strftime, trunc, epoch).
DUCKDB_ONLY = {"cast_price_float", "cast_price_int", "month_key", "epoch_month", "epoch_s_to_string", "parse_epoch"}
KEYS = [k for k in analytics.QUERIES if k not in DUCKDB_ONLY]


@pytest.mark.parametrize("key", KEYS)
def test_dataframe_form_equals_sql_form(spark, key):
    Tables(spark, SF01).register_views()
    df = analytics.QUERIES[key](spark, SF01)
    sql = spark.sql(oracle_queries()[key])
    assert sorted(df.columns) == sorted(sql.columns)
    cols = sorted(df.columns)
    # Same column order and types on both sides (SQL ranks are int, ours bigint).
    a = df.select(*cols)
    b = sql.select(*[F.col(c).cast(t) for c, t in a.dtypes])
    assert a.count() == b.count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
