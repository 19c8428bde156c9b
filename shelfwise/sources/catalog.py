"""Catalog tables: managed, external, partitioned and bucketed.

Everything is built on ``USING <datasource>`` tables, which work with the
default in-memory catalog and with a Hive metastore alike.  (``STORED AS``
and ``LOAD DATA`` need Hive support; :func:`load_delimited` replaces the
latter with a reader plus ``insertInto``.)

Scale notes
-----------
* Dynamic-partition writes: each task writes one file per partition value
  it holds.  :func:`spread_for_partitioned_write` adds a ``rebalance`` shuffle
  on the partition columns, which AQE sizes at runtime: small partitions are
  merged into fewer files and a partition value holding a third of the rows
  is split over several writer tasks instead of landing in one.
* ``INSERT OVERWRITE`` of a partitioned datasource table replaces *all*
  partitions unless ``partitionOverwriteMode=dynamic``; :func:`overwrite_partitions`
  sets it for the duration of the statement only.
* Bucketed tables hash-partition and sort on the bucket key once at write;
  joins and aggregations on that key then read the buckets without a shuffle.
  A bucketed scan runs one task per bucket, so the bucket count grows with
  the table up to a bound Spark accepts: with its bytes (:func:`buckets_for_bytes`)
  and with the rows that one task has to sort (:func:`bucket_count`).
  The write shuffles on the bucket key first, so each bucket is one file
  written by one task (without it every writer task would write a file for
  every bucket).
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import session_conf, unique_name


_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")
BUCKET_BYTES = 256 * 1024 * 1024
MAX_BUCKETS = 50_000
SORT_BYTES = 128 * 1024 * 1024
_SORT_ROW_BYTES = 48  # of a row in a sort beside its columns: lengths, and 16 for pointer and prefix in an array that doubles as it grows


def ddl_columns(schema: T.StructType) -> str:
    """``col type, ...`` for a CREATE TABLE statement."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def sql_options(options: dict[str, str]) -> str:
    """``'key' 'value', ...`` for an OPTIONS clause."""
    literal = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ", ".join(f"{literal(k)} {literal(str(v))}" for k, v in options.items())


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    using: str = "parquet",
    options: dict[str, str] | None = None,
    partitioned_by: list[str] | None = None,
    location: str | None = None,
    comment: str | None = None,
) -> str:
    """CREATE TABLE ... USING ... [OPTIONS] [PARTITIONED BY] [LOCATION]."""
    sql = f"CREATE TABLE {name} ({ddl_columns(schema)}) USING {using}"
    if options:
        sql += f" OPTIONS ({sql_options(options)})"
    if partitioned_by:
        sql += " PARTITIONED BY (" + ", ".join(partitioned_by) + ")"
    if location:
        sql += f" LOCATION '{location}'"
    if comment:
        sql += f" COMMENT '{comment}'"
    spark.sql(sql)
    return name


def load_delimited(
    spark: SparkSession,
    table: str,
    path: str,
    *,
    sep: str,
    header: bool = False,
    overwrite: bool = False,
    **options,
) -> None:
    """``LOAD DATA INPATH path [OVERWRITE] INTO TABLE table`` for delimited
    text: the file is parsed with the table's schema (header skipped if
    present) and inserted by position.  ``options`` are the reader's, such as
    ``multiLine`` for quoted fields that hold line breaks."""
    schema = spark.table(table).schema
    df = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", str(header).lower())
        .options(**options)
        .csv(path)
    )
    df.write.insertInto(table, overwrite=overwrite)


def spread_for_partitioned_write(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rebalance rows on the partition columns before a partitioned write.

    The ``rebalance`` hint is an AQE shuffle: small output partitions are
    coalesced (fewer, larger files) and a partition value holding a large
    share of the rows is split over several tasks instead of one.
    """
    return df.hint("rebalance", *partition_cols)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """INSERT OVERWRITE that replaces only the partitions present in ``df``
    (Hive's behaviour), leaving every other partition in place."""
    with session_conf(df.sparkSession, spark__sql__sources__partitionOverwriteMode="dynamic"):
        df.write.insertInto(table, overwrite=True)


def multi_insert(df: DataFrame, path: str, targets: dict[str, Column]) -> None:
    """``FROM df INSERT OVERWRITE TABLE a SELECT * WHERE .. INSERT OVERWRITE TABLE b ..`` in one scan.

    ``targets`` maps table names to conditions; a row goes to every table whose
    condition it meets, or to none.  The rows are written once, below ``path``, in a
    folder per target, and each target is an external table over its folder: a
    table of its own that needs no view and no session.  A target that exists
    is pointed to its new folder, so readers see the old rows or the new ones.
    """
    spark, mark = df.sparkSession, "target"
    while mark.lower() in (c.lower() for c in df.columns):
        mark = f"_{mark}"
    chosen = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in targets.items()]))
    rows = df.withColumn(mark, F.explode(chosen))
    spread_for_partitioned_write(rows, [mark]).write.partitionBy(mark).parquet(path)
    for name in targets:
        folder = f"{path}/{mark}={name}"
        if spark.catalog.tableExists(name):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
        else:
            create_table(spark, name, df.schema, location=folder)


def buckets_for_bytes(size: int, minimum: int = 1) -> int:
    """Buckets for a table of ``size`` bytes: one per ``BUCKET_BYTES``, at most
    ``MAX_BUCKETS``.

    Spark refuses more than 100,000 buckets.  Beyond the bound buckets grow
    instead (2 GB each at 100 TB): the one task that reads or sorts a bucket
    may spill, and no row is left out.
    """
    return min(MAX_BUCKETS, max(minimum, -(-size // BUCKET_BYTES)))


def planned_bytes(df: DataFrame) -> int:
    """The planner's size of a query, as ``EXPLAIN COST`` prints it."""
    spark, view = df.sparkSession, unique_name("sized")
    df.createTempView(view)
    try:
        text = spark.sql(f"EXPLAIN COST SELECT * FROM {view}").first()[0]
    finally:
        spark.catalog.dropTempView(view)
    size, unit = re.search(r"sizeInBytes=([0-9.E+]+) (\w+)", text).groups()
    return math.ceil(float(size) * 1024 ** _UNITS.index(unit))


def sorted_bytes(df: DataFrame) -> int:
    """About the memory that a sort of all rows takes: their number (one count; a plain
    Parquet scan answers it from its footers) times the planner's size of a row."""
    return df.count() * (planned_bytes(df.limit(1)) + _SORT_ROW_BYTES)


def bucket_count(*dfs: DataFrame, minimum: int = 1) -> int:
    """Buckets for tables that will be joined on their bucket key.

    Two bounds hold up to ``MAX_BUCKETS``: the planner's size of the largest input
    (file sizes for a scan) is at most ``BUCKET_BYTES`` a bucket, and the rows of one
    bucket of every table, which the task that joins them sorts, take at most
    ``SORT_BYTES``.  The second needs the rows: few bytes of compressed columns
    may hold many.  Tables joined bucket to bucket must share the count.
    """
    by_files = buckets_for_bytes(max(map(planned_bytes, dfs)), minimum)
    return min(MAX_BUCKETS, max(by_files, -(-sum(map(sorted_bytes, dfs)) // SORT_BYTES)))


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, fmt: str = "parquet") -> str:
    """``CLUSTERED BY (key) SORTED BY (key) INTO buckets BUCKETS``.

    ``repartition(buckets, key)`` uses the same hash as the bucketing, so
    every writer task holds exactly one bucket and writes one file.  A bucket
    key holding a third of all rows puts that third in one bucket; such a key
    should not be a bucket key on its own.
    """
    (
        df.repartition(buckets, key)
        .write.format(fmt)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(name)
    )
    return name


def heavy_keys(df: DataFrame, key: str, share: float, tracked: int = 10_000) -> dict:
    """Keys with more than ``share`` of all rows, and their exact counts.

    Candidates come from a mergeable frequent-items sketch, which misses none
    whose share is above about 1 / ``tracked``; a second pass counts them exactly.
    At most 1 / ``share`` keys reach the driver.
    """
    k = max(1, min(tracked // 2, math.ceil(1 / share)))
    found = df.agg(F.expr(f"approx_top_k(`{key}`, {k}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    named = [r["item"] for r in found["top"] or [] if r["item"] is not None]
    if not named:
        return {}
    counts = df.where(F.col(key).isin(named)).groupBy(key).count().where(F.col("count") > share * found["n"])
    return {r[key]: (r["count"], found["n"]) for r in counts.collect()}


SALT = "bucket_salt"
_FINE = 8  # salts per bucket that a heavy key would fill: chunks small enough to fall evenly


def save_bucketed_pair(large: DataFrame, small: DataFrame, large_name: str, small_name: str, key: str, buckets: int) -> dict:
    """Two tables bucketed on ``key`` for a join without exchange, whatever share of ``large`` one key holds.

    A key with more than an eighth of a bucket is heavy: its rows in ``large``
    are cut into chunks of that size by a hash of the row, numbered in a salt
    column, and its rows in ``small`` are there once per chunk.  Both tables are bucketed and
    sorted on (key, salt), so a heavy key spreads over the buckets as many
    keys would.  Other keys have salt 0 on both sides.  Returns the chunks per heavy key.
    """
    heavy = {k: math.ceil(_FINE * n * buckets / total) for k, (n, total) in heavy_keys(large, key, 1 / (_FINE * buckets)).items()}
    kind = large.schema[key].dataType
    chunks = F.lit(1)
    if heavy:
        listed = F.create_map(*[x for k, n in heavy.items() for x in (F.lit(k).cast(kind), F.lit(n))])
        chunks = F.when(F.col(key).isNotNull(), F.coalesce(F.element_at(listed, F.col(key)), F.lit(1))).otherwise(1)
    salted = large.withColumn(SALT, F.pmod(F.xxhash64(*large.columns), chunks).cast("int"))
    spread = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), chunks - 1)))
    for df, name in ((salted, large_name), (spread, small_name)):
        df.repartition(buckets, key, SALT).write.bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(name)
    return heavy


def join_bucketed_pair(spark: SparkSession, large_name: str, small_name: str, key: str) -> DataFrame:
    """The inner join of two tables saved by :func:`save_bucketed_pair`; no row is shuffled."""
    return spark.table(large_name).join(spark.table(small_name).hint("merge"), [key, SALT]).drop(SALT)


def write_value_manifest(spark: SparkSession, files: str, path: str, column: str) -> None:
    """For every value of ``column`` the files below ``files`` that hold it, as bitmaps over file numbers.

    One pass over one column: file numbers are the order of the file names from 1,
    bits are set by a mergeable aggregate (a map-side bitmap per value), and the rows
    are sorted by value, so a look-up reads a few row groups.  The file names are
    kept beside them.
    """
    rows = spark.read.parquet(files).select(F.col(column).alias("value"), F.col("_metadata.file_path").alias("file"))
    names = sorted(r[0] for r in rows.select("file").distinct().collect())  # as the driver's own listing has them
    numbered = spark.createDataFrame([(n, i) for i, n in enumerate(names, 1)], "file string, number long")
    numbered.coalesce(1).write.parquet(f"{path}/files")
    bits = rows.distinct().join(F.broadcast(numbered), "file").select("value", F.bitmap_bucket_number("number").alias("block"), F.bitmap_bit_position("number").alias("bit"))
    found = bits.groupBy("value", "block").agg(F.bitmap_construct_agg("bit").alias("files"))
    found.repartitionByRange("value").sortWithinPartitions("value").write.option("parquet.bloom.filter.enabled#value", "true").parquet(f"{path}/values")


def files_with(spark: SparkSession, path: str, value) -> list[str]:
    """The files that hold ``value``, from a manifest; their bitmaps are all that is read."""
    rows = spark.read.parquet(f"{path}/values").where(F.col("value") == F.lit(value)).collect()  # one row per 32,768 files
    numbers = [(r["block"] - 1) * 32_768 + 8 * k + bit + 1 for r in rows for k, byte in enumerate(r["files"]) if byte for bit in range(8) if byte >> bit & 1]
    names = spark.read.parquet(f"{path}/files").where(F.col("number").isin(numbers)).select("file").collect() if numbers else []
    return sorted(r[0] for r in names)


def write_lookup_layout(
    df: DataFrame,
    path: str,
    key: str,
    files: int,
    *,
    spread_by: list[str] | None = None,
    bloom_filter: bool = True,
) -> str:
    """Point-lookup layout (replaces a Hive index): rows range partitioned and
    sorted on ``key``, so each file covers a narrow key range (row-group
    min/max stats skip the rest) plus a Parquet bloom filter on ``key``.
    A lookup is then a plain ``filter(key == v)`` pushed into the scan.

    ``spread_by`` adds columns to the range key after ``key``.  Range
    partitioning never splits one key value, so without them a value holding
    a third of the rows would be one partition written by one task; with them
    that value spans several consecutive files and the layout stays sorted
    on ``key``."""
    order = [key, *(spread_by or [])]
    w = df.repartitionByRange(files, *order).sortWithinPartitions(*order).write
    if bloom_filter:
        w = w.option(f"parquet.bloom.filter.enabled#{key}", "true")
    w.parquet(path)
    return path


def table_is_external(spark: SparkSession, name: str) -> bool:
    """True if ``name`` is an EXTERNAL table (dropping it keeps its files)."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == "Type")
    return rows.select("data_type").first()[0].upper() == "EXTERNAL"
