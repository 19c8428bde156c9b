"""SequenceFile read and write: the one place this package uses RDDs.

Hadoop SequenceFiles hold (key, value) Writables and have no DataFrame
source, so rows cross into Python once per task at this boundary.  The key
and value are prepared in the JVM first (``concat_ws`` of the columns, keys as
text), so the Python step is only a tuple hand-off; after reading, splitting
and casting happen in the JVM again.  Values are stored as ``Text``: tuple
values would become ``ArrayWritable``, which cannot be read back.
"""

from __future__ import annotations

import re
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.session import scratch_path
from shelfwise.sources.formats import delimited_fields, delimited_value, field_text, parse_delimited_lines, typed_field

# Hadoop class names used at the SequenceFile boundary.
TEXT = "org.apache.hadoop.io.Text"
NULL_WRITABLE = "org.apache.hadoop.io.NullWritable"
SEQ_OUTPUT_FORMAT = "org.apache.hadoop.mapreduce.lib.output.SequenceFileOutputFormat"
SEQ_INPUT_FORMAT = "org.apache.hadoop.mapreduce.lib.input.SequenceFileInputFormat"
CODEC_CLASSES = {
    "gzip": "org.apache.hadoop.io.compress.GzipCodec",
    "bzip2": "org.apache.hadoop.io.compress.BZip2Codec",
    "deflate": "org.apache.hadoop.io.compress.DefaultCodec",
    "snappy": "org.apache.hadoop.io.compress.SnappyCodec",
}

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"

KV_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])


def _kv_rows(df: DataFrame, sep: str, key_first: bool) -> DataFrame:
    cols = df.columns
    if key_first:
        return df.select(
            field_text(F.col(cols[0]), df.schema[cols[0]].dataType, sep).alias("key"),
            delimited_value(df, sep, cols[1:]).alias("value"),
        )
    return df.select(F.lit(None).cast("string").alias("key"), delimited_value(df, sep).alias("value"))


def write_sequence(
    df: DataFrame,
    path: str,
    *,
    key_first: bool = True,
    sep: str = "|",
    codec: str | None = None,
    new_api: bool = False,
) -> str:
    """Save rows as a SequenceFile of (Text key | NullWritable, Text value).

    ``key_first``: first column is the key (a null as the null mark), the rest
    joined by ``sep`` is the value; otherwise the key is null and the value
    holds every column.
    """
    kv = _kv_rows(df, sep, key_first).rdd.map(tuple)
    if new_api:
        kv.saveAsNewAPIHadoopFile(
            path,
            SEQ_OUTPUT_FORMAT,
            keyClass=TEXT if key_first else NULL_WRITABLE,
            valueClass=TEXT,
        )
    else:
        kv.saveAsSequenceFile(path, CODEC_CLASSES[codec] if codec else None)
    return path


def read_sequence(spark: SparkSession, path: str, *, new_api: bool = False, key_class: str | None = TEXT) -> DataFrame:
    """Read a SequenceFile into a (key string, value string) DataFrame; without
    a ``key_class`` the classes are those named in the files."""
    sc = spark.sparkContext
    if new_api:
        rdd = sc.newAPIHadoopFile(path, SEQ_INPUT_FORMAT, key_class or TEXT, TEXT)
    elif key_class is None:
        rdd = sc.sequenceFile(path)
    else:
        rdd = sc.sequenceFile(path, key_class, TEXT)
    return spark.createDataFrame(rdd, KV_SCHEMA, verifySchema=False)


def sequence_to_table(kv: DataFrame, schema: T.StructType, *, key_first: bool = True, sep: str = "|") -> DataFrame:
    """Turn (key, value) rows back into the typed columns of ``schema``."""
    if not key_first:
        return parse_delimited_lines(kv, sep, schema)
    first, rest = schema.fields[0], T.StructType(schema.fields[1:])
    return kv.select(typed_field(F.col("key"), first, sep), *delimited_fields(F.col("value"), sep, rest))


def write_sequence_partitions(df: DataFrame, path: str, by: str, **options) -> list:
    """A SequenceFile folder ``by=value`` for every value of ``by``, as a partitioned
    table stored as SequenceFile has; the values.

    SequenceFiles are written one folder at a time, so the rows are first dealt
    into partitions in one pass (a Parquet table in the shared scratch folder), and
    each folder is then written from its own partition alone.  ``by`` has as many
    values as the table has partitions, a few thousand at most.
    """
    spark, kind = df.sparkSession, df.schema[by].dataType
    staged = scratch_path(spark, "sequence-partitions")
    df.hint("rebalance", by).write.partitionBy(by).parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    values = sorted((r[0] for r in rows.select(by).distinct().collect()), key=lambda v: (v is not None, v))
    for value in values:
        own = rows.where(F.col(by).eqNullSafe(F.lit(value).cast(kind))).drop(by)
        write_sequence(own, f"{path}/{by}={_folder(value)}", **options)
    return values


def _folder(value) -> str:
    return DEFAULT_PARTITION if value is None else quote(str(value), safe="")


def sequence_partitions(spark: SparkSession, path: str, by: str, kind: T.DataType) -> dict:
    """Value -> folder of a partitioned SequenceFile table, from the names of its folders."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    name = F.regexp_extract("path", rf"/{re.escape(by)}=([^/]+)/[^/]+$", 1)
    texts = sorted(r[0] for r in files.select(name).distinct().collect() if r[0])
    plain = [(t, None if t == DEFAULT_PARTITION else unquote(t)) for t in texts]
    typed = spark.createDataFrame(plain, "folder string, value string").select("folder", F.col("value").cast(kind).alias("value"))
    return {r["value"]: f"{path}/{by}={r['folder']}" for r in typed.collect()}


def read_sequence_partitions(spark: SparkSession, path: str, schema: T.StructType, by: str, values: list | None = None, *, key_first: bool = True, sep: str = "|") -> DataFrame:
    """The rows of a partitioned SequenceFile table; ``by`` comes from the folders' names.

    With ``values`` only their folders are opened.
    """
    kind, rest = schema[by].dataType, T.StructType([f for f in schema.fields if f.name != by])
    folders = sequence_partitions(spark, path, by, kind)
    wanted = folders if values is None else {v: f for v, f in folders.items() if v in values}
    table = None
    for value, folder in wanted.items():
        rows = sequence_to_table(read_sequence(spark, folder, key_class=TEXT if key_first else NULL_WRITABLE), rest, key_first=key_first, sep=sep)
        rows = rows.withColumn(by, F.lit(value).cast(kind)).select(*schema.names)
        table = rows if table is None else table.unionByName(rows)
    return table if table is not None else spark.createDataFrame([], schema)
