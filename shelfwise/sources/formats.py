"""Format x codec conversion with Spark's DataFrame reader and writer.

``write_as`` / ``read_as`` cover Parquet, ORC, JSON, CSV, text and XML (XML is
built into Spark 4).  Readers of self-describing formats use the embedded
schema; readers of text formats take an explicit schema, because inference
costs an extra pass over the data and changes integer widths and column order.
Each writer task writes its own files, so conversion scales with the number
of input partitions and never funnels through the driver.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The codecs each writer accepts here (Spark 4.1, no native LZO).
CODECS = {
    "parquet": ("none", "uncompressed", "snappy", "gzip", "zstd", "lz4_raw"),
    "orc": ("none", "snappy", "zlib", "lz4", "zstd"),
    "json": ("none", "gzip", "bzip2", "deflate", "snappy", "lz4"),
    "csv": ("none", "gzip", "bzip2", "deflate", "snappy", "lz4"),
    "text": ("none", "gzip", "bzip2", "deflate", "snappy", "lz4"),
    "xml": ("none", "gzip", "bzip2", "deflate", "snappy", "lz4"),
}

# Fixed value: how a null is printed in delimited text lines (Hive's marker).
NULL_MARK = "\\N"

# Quotes inside quoted CSV fields are doubled; a null is the
# mark, so an empty string stays one.
CSV_QUOTING = {"quote": '"', "escape": '"', "nullValue": NULL_MARK}

XML_ROW_TAG = "row"
XML_ROOT_TAG = "rows"


def write_as(
    df: DataFrame,
    path: str,
    fmt: str,
    compression: str | None = None,
    mode: str = "error",
    **options,
) -> str:
    """Write ``df`` at ``path`` as ``fmt`` with ``compression``; return path."""
    if compression is not None and fmt in CODECS and compression not in CODECS[fmt]:
        raise ValueError(f"codec {compression!r} not supported for {fmt}")
    w = df.write.mode(mode).format(fmt)
    if compression is not None:
        w = w.option("compression", compression)
    if fmt == "xml":
        options.setdefault("rowTag", XML_ROW_TAG)
        options.setdefault("rootTag", XML_ROOT_TAG)
    by = options.pop("partitionBy", None)
    if by is not None:
        w = w.partitionBy(by)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def read_as(
    spark: SparkSession,
    path: str,
    fmt: str,
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Read ``path`` as ``fmt``; pass ``schema`` for text-based formats."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "xml":
        options.setdefault("rowTag", XML_ROW_TAG)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def convert(
    df: DataFrame,
    path: str,
    fmt: str,
    compression: str | None = None,
    **options,
) -> DataFrame:
    """Write ``df`` as ``fmt`` and return the table read back from ``path``.

    The read uses ``df``'s schema for formats that do not embed one, so the
    result has the same columns and types as the input.  CSV strings are
    written with their line breaks escaped, so files stay splittable and every
    value comes back as it was.
    """
    csv = fmt == "csv"
    if csv:
        options = CSV_QUOTING | options
    write_as(map_strings(df, lambda c: escape(c)) if csv else df, path, fmt, compression, **options)
    embedded = fmt in ("parquet", "orc", "avro")
    read_opts = {k: v for k, v in options.items() if k in ("sep", "header", "quote", "escape", "nullValue", "lineSep", "rowTag", "encoding")}
    back = read_as(df.sparkSession, path, fmt, None if embedded else df.schema, **read_opts)
    return map_strings(back, lambda c: unescape(c)) if csv else back


def _marks(sep: str, line_sep: str) -> dict[str, str]:
    """The character written after a backslash for each character that may not
    stand in a line: none of them is part of a separator itself."""
    if not sep.isascii() or "\\" in sep + line_sep or "\n" in sep or "\r" in sep:
        raise ValueError("a separator must not hold a backslash or a line break")
    special = list(dict.fromkeys(["\n", "\r", *line_sep, *sep]))
    free = [c for c in "nrtsdquvwxyz" if c not in sep + line_sep]
    return dict(zip(special, free, strict=False))


def escape(text: Column, sep: str = "", line_sep: str = "\n") -> Column:
    """``text`` without line breaks or separators: each is a backslash and a
    letter instead, and a backslash is two."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, mark in _marks(sep, line_sep).items():
        out = F.replace(out, F.lit(char), F.lit("\\" + mark))
    return out


def unescape(text: Column, sep: str = "", line_sep: str = "\n") -> Column:
    """Undo :func:`escape`.  Pairs of backslashes are set apart first, so what
    is left after each of them is a mark."""

    def plain(part: Column) -> Column:
        for char, mark in _marks(sep, line_sep).items():
            part = F.replace(part, F.lit("\\" + mark), F.lit(char))
        return part

    pairs = F.split(text, re.escape("\\\\"), -1)
    whole = F.array_join(F.transform(pairs, plain), "\\")
    return F.when(F.instr(text, "\\") > 0, whole).otherwise(text)


def map_strings(df: DataFrame, change) -> DataFrame:
    """``df`` with ``change`` applied to every string column."""
    return df.select(
        *[change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in df.schema.fields]
    )


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON document per row (``toJSON``), as a single ``value`` column.
    Nulls are written, so a column without any value keeps its name."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))


def field_text(c: Column, kind: T.DataType, sep: str, line_sep: str = "\n") -> Column:
    """One field of a delimited line; a null is ``NULL_MARK``, which no escaped text equals."""
    text = escape(c, sep, line_sep) if isinstance(kind, T.StringType) else c.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def delimited_value(df: DataFrame, sep: str, columns: list[str] | None = None, line_sep: str = "\n") -> Column:
    """Column expression: the given columns as one ``sep``-delimited string.
    Separators, line breaks and backslashes inside strings are escaped."""
    cols = columns if columns is not None else df.columns
    return F.concat_ws(sep, *[field_text(F.col(c), df.schema[c].dataType, sep, line_sep) for c in cols])


def to_delimited_lines(df: DataFrame, sep: str, line_sep: str = "\n") -> DataFrame:
    """One delimited text line per row in a ``value`` column."""
    return df.select(delimited_value(df, sep, line_sep=line_sep).alias("value"))


def parse_delimited_lines(lines: DataFrame, sep: str, schema: T.StructType, col: str = "value", line_sep: str = "\n") -> DataFrame:
    """Split ``sep``-delimited lines into the typed columns of ``schema``; a
    line with another number of fields is an error."""
    return lines.select(*delimited_fields(F.col(col), sep, schema, line_sep))


def delimited_fields(line: Column, sep: str, schema: T.StructType, line_sep: str = "\n") -> list[Column]:
    """The typed columns of ``schema`` from a delimited line."""
    parts, n = F.split(line, re.escape(sep), -1), len(schema.fields)
    wrong = F.raise_error(F.concat(F.lit(f"expected {n} fields: "), line))
    checked = F.when(F.size(parts) == n, parts).otherwise(wrong.cast("array<string>"))
    return [typed_field(checked.getItem(i), f, sep, line_sep) for i, f in enumerate(schema.fields)]


def typed_field(text: Column, field: T.StructField, sep: str, line_sep: str = "\n") -> Column:
    """A field written by :func:`field_text` as its type."""
    value = unescape(text, sep, line_sep) if isinstance(field.dataType, T.StringType) else text
    return F.when(text != F.lit(NULL_MARK), value).cast(field.dataType).alias(field.name)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns from ``df`` by name, cast to its types; a
    column that is not there is null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


# What a text can be read as, one bit each, so that "or" joins the evidence of many rows.
_INT, _LONG, _DECIMAL, _DOUBLE, _BOOLEAN, _DATE, _TIMESTAMP, _STRING = (1 << k for k in range(8))
_WHOLE = r"^(0|-?[1-9][0-9]*)$"
_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"


def _evidence(text: Column, nulls: tuple[str, ...]) -> Column:
    """The bit of the narrowest type a text can be read as; 0 for null and the null marks."""
    whole = (
        F.when(text.try_cast("int").isNotNull(), _INT)
        .when(text.try_cast("bigint").isNotNull(), _LONG)
        .when(F.length(text) <= 38, _DECIMAL)
        .otherwise(_STRING)
    )
    return (
        F.when(text.isNull() | text.isin(*nulls), 0)
        .when(text.rlike(_WHOLE), whole)
        .when(text.rlike(_NUMBER), _DOUBLE)
        .when(F.lower(text).isin("true", "false"), _BOOLEAN)
        .when(text.rlike(_DAY) & text.try_cast("date").isNotNull(), _DATE)
        .when(text.rlike(_MOMENT) & text.try_cast("timestamp_ntz").isNotNull(), _TIMESTAMP)
        .otherwise(_STRING)
    )


def _join(bits: int) -> T.DataType:
    """The least type that holds everything the bits say; no evidence, or none in common, is a string."""
    for kind, holds in (
        (T.IntegerType(), _INT),
        (T.LongType(), _INT | _LONG),
        (T.DecimalType(38, 0), _INT | _LONG | _DECIMAL),
        (T.DoubleType(), _INT | _LONG | _DECIMAL | _DOUBLE),
        (T.BooleanType(), _BOOLEAN),
        (T.DateType(), _DATE),
        (T.TimestampNTZType(), _DATE | _TIMESTAMP),
    ):
        if bits and not bits & ~holds:
            return kind
    return T.StringType()


def infer_schema(rows: DataFrame, nulls: tuple[str, ...] = ("",)) -> T.StructType:
    """The types of text columns, from all their values.

    Every value votes for the narrowest type it can be read as; votes are bits,
    joined by ``bit_or``, so one pass with a partial aggregate covers any number of rows and
    one row of numbers reaches the driver.  The types form a lattice: int < bigint <
    decimal(38,0) < double, date < timestamp, and string above all.  Whole numbers with
    leading zeros or a plus sign are codes, not numbers: they stay strings, as
    nothing would bring the zeros back.
    """
    found = rows.agg(*[F.coalesce(F.bit_or(_evidence(F.col(c), nulls)), F.lit(0)).alias(c) for c in rows.columns]).first()
    return T.StructType([T.StructField(c, _join(found[k])) for k, c in enumerate(rows.columns)])


def with_inferred_types(rows: DataFrame, nulls: tuple[str, ...] = ("",)) -> DataFrame:
    """Text columns as the types :func:`infer_schema` finds; the null marks become null."""
    schema = infer_schema(rows, nulls)
    return rows.select(*[F.when(~F.col(f.name).isin(*nulls), F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields])
