"""Format and codec round trips bound to the test tables.

Each key writes a given table in one format x codec below the shared scratch
folder and returns the table read back, so the result must equal the source
(the oracle selects from the original table).  Output paths are unique per
call and never deleted here: the returned DataFrame is lazy and reads them
when the caller runs it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import cleaning
from shelfwise.session import scratch_path
from shelfwise.sources import formats, sequence
from shelfwise.sources.tables import Tables

# Separators used by the delimited round trips.
PIPE = "|"
TAB = "\t"


def _part(spark, sf_dir) -> DataFrame:
    return Tables(spark, sf_dir).part


def _round_trip(fmt: str, codec: str | None, **options):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = _part(spark, sf_dir)
        path = scratch_path(spark, f"part-{fmt}-{codec or 'default'}")
        return formats.convert(src, path, fmt, codec, **options)

    run.__name__ = f"io_{fmt}_{codec}"
    return run


def json_strings_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows -> JSON strings (``toJSON``) -> gzip text files -> JSON reader
    with an inferred schema (integers come back as bigint, columns sorted by
    name), cast back to the source types by column name."""
    src = _part(spark, sf_dir)
    path = scratch_path(spark, "part-json-strings-gzip")
    formats.write_as(formats.to_json_lines(src), path, "text", "gzip")
    return formats.cast_to_schema(formats.read_as(spark, path, "json"), src.schema)


def _text_lines(codec: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Rows as tab-delimited text lines, compressed, parsed back."""
        src = _part(spark, sf_dir)
        path = scratch_path(spark, f"part-text-{codec}")
        formats.write_as(formats.to_delimited_lines(src, TAB), path, "text", codec)
        return formats.parse_delimited_lines(formats.read_as(spark, path, "text"), TAB, src.schema)

    run.__name__ = f"io_text_{codec}"
    return run


def io_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe-delimited CSV with header, read with schema inference, then cast
    back to the source types by column name."""
    src = _part(spark, sf_dir)
    path = scratch_path(spark, "part-csv-infer")
    formats.write_as(formats.map_strings(src, formats.escape), path, "csv", "none", sep=PIPE, header="true", **formats.CSV_QUOTING)
    inferred = formats.read_as(spark, path, "csv", sep=PIPE, header="true", inferSchema="true", **formats.CSV_QUOTING)
    return formats.map_strings(formats.cast_to_schema(inferred, src.schema), formats.unescape)


def io_csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field that contains the delimiter is quoted on write and stays one
    field on read; empty fields come back as null."""
    src = _part(spark, sf_dir).select(
        "p_partkey",
        F.concat_ws(PIPE, "p_name", "p_brand").alias("p_label"),
        F.when(F.col("p_size") > 25, F.col("p_type")).alias("p_type"),
        "p_retailprice",
    )
    path = scratch_path(spark, "part-csv-quoted")
    quoting = {"quote": '"', "escape": '"'}
    formats.write_as(formats.map_strings(src, formats.escape), path, "csv", "none", sep=PIPE, emptyValue="", **quoting)
    back = formats.read_as(spark, path, "csv", src.schema, sep=PIPE, encoding="UTF-8", **quoting)
    return formats.map_strings(back, formats.unescape)


def _sequence(key_first: bool, codec: str | None = None, new_api: bool = False, inferred: bool = False):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        src = _part(spark, sf_dir)
        path = scratch_path(spark, "part-seq")
        sequence.write_sequence(src, path, key_first=key_first, codec=codec, new_api=new_api)
        key_class = None if inferred else sequence.TEXT if key_first else sequence.NULL_WRITABLE
        kv = sequence.read_sequence(spark, path, new_api=new_api, key_class=key_class)
        return sequence.sequence_to_table(kv, src.schema, key_first=key_first)

    return run


def split_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated text lines -> split -> columns typed by a declared
    schema (``createDataFrame(rdd.map(split), schema)`` done in the JVM)."""
    customer = Tables(spark, sf_dir).customer.select("c_custkey", "c_name", "c_acctbal")
    path = scratch_path(spark, "customer-lines")
    formats.write_as(formats.to_delimited_lines(customer, ","), path, "text")
    declared = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_acctbal", T.DoubleType()),
        ]
    )
    return formats.parse_delimited_lines(formats.read_as(spark, path, "text"), ",", declared)


def infer_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text lines -> split -> types inferred from all values: whole numbers,
    numbers with and without a fraction, dates with gaps, dates among timestamps,
    codes with leading zeros, and columns with words among the numbers or dates."""
    orders = Tables(spark, sf_dir).orders
    key, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.col("o_totalprice")
    dirty = orders.select(
        key.cast("string").alias("order_id"),
        F.when(key % 10 == 0, price.cast("bigint").cast("string")).otherwise(price.cast("string")).alias("price"),
        F.when(key % 7 == 0, F.lit("")).otherwise(day).alias("order_day"),
        F.when(key % 2 == 0, day).otherwise(F.concat(day, F.lit(" 10:20:30"))).alias("order_moment"),
        (F.when(key % 2 == 0, F.lit("true")).otherwise(F.lit("False"))).alias("even"),
        F.lpad(F.col("o_custkey").cast("string"), 9, "0").alias("customer_code"),
        F.when(key % 100 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("customer"),
        F.when(key % 100 == 1, F.lit("unknown")).otherwise(day).alias("ship_day"),
    )
    path = scratch_path(spark, "orders-dirty-lines")
    formats.write_as(formats.to_delimited_lines(dirty, ","), path, "text")
    text = T.StructType([T.StructField(c, T.StringType()) for c in dirty.columns])
    return formats.with_inferred_types(formats.parse_delimited_lines(formats.read_as(spark, path, "text", "value string"), ",", text))


def split_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines split at their first comma: the key, and the rest as one value."""
    nation = Tables(spark, sf_dir).nation
    path = scratch_path(spark, "nation-lines")
    lines = nation.select(F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey").alias("value"))
    formats.write_as(lines, path, "text")
    return formats.read_as(spark, path, "text").select(*cleaning.split_first("value", ","))


def sql_on_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SELECT * FROM parquet.`path``` without registering a table."""
    path = Tables(spark, sf_dir).path("part")
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def save_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four save modes against a target that already holds the table.

    error: the write raises and the target keeps its rows; append: twice the
    rows; ignore: unchanged; overwrite: exactly the new rows.  Returns
    (mode, n_rows) counted by Spark from the targets.
    """
    src = _part(spark, sf_dir)
    results = []
    for mode in ("error", "append", "ignore", "overwrite"):
        path = scratch_path(spark, f"part-mode-{mode}")
        src.write.parquet(path)
        try:
            src.write.mode(mode).parquet(path)
        except Exception as exc:
            if mode != "error":
                raise
            if "PATH_ALREADY_EXISTS" not in str(exc) and "already exists" not in str(exc):
                raise
        results.append(spark.read.parquet(path).select(F.lit(mode).alias("mode")))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out.groupBy("mode").agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    "io_parquet_none": _round_trip("parquet", "none"),
    "io_parquet_snappy": _round_trip("parquet", "snappy"),
    "io_parquet_gzip": _round_trip("parquet", "gzip"),
    "io_orc": _round_trip("orc", "snappy"),
    "io_json_none": _round_trip("json", "none"),
    "io_json_gzip": _round_trip("json", "gzip"),
    "json_strings_gzip": json_strings_gzip,
    "io_csv_gzip": _round_trip("csv", "gzip", sep=PIPE),
    "io_csv_infer": io_csv_infer,
    "io_csv_quoted": io_csv_quoted,
    "io_text_gzip": _text_lines("gzip"),
    "io_text_bzip2": _text_lines("bzip2"),
    "io_xml": _round_trip("xml", "none"),
    "io_sequence_kv": _sequence(True),
    "io_sequence_null": _sequence(False),
    "io_sequence_bzip2": _sequence(True, "bzip2", inferred=True),
    "io_sequence_newapi": _sequence(True, new_api=True),
    "split_typed_rows": split_typed_rows,
    "infer_typed_rows": infer_typed_rows,
    "split_first_rows": split_first_rows,
    "sql_on_files": sql_on_files,
    "save_modes": save_modes,
}

_PART = "select * from part"

ORACLE_SQL = {k: _PART for k in QUERIES if k not in ("io_csv_quoted", "save_modes", "split_typed_rows", "infer_typed_rows", "split_first_rows")}
ORACLE_SQL["split_typed_rows"] = "select c_custkey, c_name, c_acctbal from customer"
ORACLE_SQL["infer_typed_rows"] = """
    select cast(o_orderkey as integer) as order_id,
           case when o_orderkey % 10 = 0 then trunc(o_totalprice) else o_totalprice end as price,
           case when o_orderkey % 7 <> 0 then cast(o_orderdate as date) end as order_day,
           cast(cast(o_orderdate as date) as timestamp) + case when o_orderkey % 2 = 0 then interval 0 second else interval 37230 second end as order_moment,
           o_orderkey % 2 = 0 as even,
           lpad(cast(o_custkey as varchar), 9, '0') as customer_code,
           case when o_orderkey % 100 = 0 then 'n/a' else cast(o_custkey as varchar) end as customer,
           case when o_orderkey % 100 = 1 then 'unknown' else strftime(o_orderdate, '%Y-%m-%d') end as ship_day
    from orders"""
ORACLE_SQL["split_first_rows"] = """
    select cast(n_nationkey as varchar) as key, n_name || ',' || cast(n_regionkey as varchar) as value
    from nation"""
ORACLE_SQL["io_csv_quoted"] = """
    select p_partkey, concat_ws('|', p_name, p_brand) as p_label,
           case when p_size > 25 then p_type end as p_type, p_retailprice
    from part"""
ORACLE_SQL["save_modes"] = """
    select 'error' as mode, count(*) as n_rows from part
    union all select 'append', 2 * count(*) from part
    union all select 'ignore', count(*) from part
    union all select 'overwrite', count(*) from part"""
