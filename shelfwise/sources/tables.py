"""Loading the parquet tables a pipeline runs on.

``Tables`` is a thin, lazy accessor: ``tables.orders`` is
``spark.read.parquet(f"{root}/orders.parquet")``.  Nothing is read until an
action runs, so Catalyst prunes columns and pushes filters into each scan
(``ReadSchema`` / ``PushedFilters`` in ``explain``).

Every access lists the table's files anew, so files appended since the last
query are read.  The schema is read from a footer once per session and path and
handed to later reads, which then start no job of their own; a table whose
columns change while a session runs needs :func:`forget_schemas`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLE_NAMES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """``spark.read.parquet(path)`` that infers the schema of a path once per session."""
    key = spark.sparkContext.applicationId, path
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def forget_schemas() -> None:
    """Infer every schema anew at its next read."""
    _SCHEMAS.clear()


class Tables:
    """Lazy access to ``<root>/<name>.parquet`` tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def load(self, name: str) -> DataFrame:
        return read_parquet(self.spark, self.path(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.load(name)
        raise AttributeError(name)

    def register_views(self, names=TABLE_NAMES) -> None:
        """Register each table as a temp view of the same name."""
        for name in names:
            self.load(name).createOrReplaceTempView(name)
