"""Reading database tables over JDBC.

Scale notes: a JDBC table is read by ``num_partitions`` concurrent queries,
each over one stride of ``partition_column``; ``lowerBound``/``upperBound``
only set the strides and do not filter, so a bounded import also adds the
range as a filter (pushed into each query's WHERE clause).  The bounds come
from one ``select min, max`` query run by the database, not by scanning the
table in Spark.  Credentials are parameters, never literals in code.

Not exercised by the registered queries: they would need a database, and the
test environment runs none (see README).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    opts = {"url": url, "fetchsize": str(fetch_size)}
    if table is not None:
        opts["dbtable"] = table
    if query is not None:
        opts["query"] = query
    for k, v in (("driver", driver), ("user", user), ("password", password)):
        if v is not None:
            opts[k] = v
    return opts


def partition_options(column: str, lower: int, upper: int, num_partitions: int) -> dict[str, str]:
    """Options for a parallel read split on ``column`` (``--split-by -m``)."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    if upper < lower:
        raise ValueError("upper bound below lower bound")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(num_partitions),
    }


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def bounds(spark: SparkSession, url: str, table: str, column: str, where: str | None = None, **conn) -> tuple:
    """``--boundary-query``: min and max of ``column`` computed by the database."""
    q = f"select min({column}) as lo, max({column}) as hi from {table}"
    if where:
        q += f" where {where}"
    row = read_table(spark, jdbc_options(url, query=q, **conn)).first()
    return row[0], row[1]


def read_bounded(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    num_partitions: int,
    **conn,
) -> DataFrame:
    """Rows with ``lower <= column <= upper``, read by ``num_partitions``
    parallel queries."""
    opts = jdbc_options(url, table=table, **conn)
    opts.update(partition_options(column, lower, upper, num_partitions))
    return read_table(spark, opts).where(F.col(column).between(lower, upper))
