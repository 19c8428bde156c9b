"""Text formats give back every value they were given."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfwise.operators import ingest
from shelfwise.session import scratch_path
from shelfwise.sources import catalog, formats, sequence

ROWS = [
    (1, "a|b", "x", 1.5, None),
    (2, "\\N", "", None, None),
    (3, "line\nbreak\r\nand\ttab", 'say "hi"', 2.0, None),
    (4, None, "back\\slash\\\\n", -0.25, None),
    (None, "*;,", "\\", 3.0, None),
    (6, "\\p\\s\\n", "é 日本", 4.0, None),
]
SCHEMA = "id int, a string, b string, n double, nothing string"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _same(got, want=ROWS):
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("sep", ["|", "\t", ",", "*", "n", "::"])
def test_delimited_lines(spark, table, sep):
    path = scratch_path(spark, "lossless-text")
    formats.write_as(formats.to_delimited_lines(table, sep), path, "text", "gzip")
    _same(formats.parse_delimited_lines(formats.read_as(spark, path, "text"), sep, table.schema))


def test_other_line_end(spark, table):
    path = scratch_path(spark, "lossless-line-end")
    formats.write_as(formats.to_delimited_lines(table, "|", ";"), path, "text", lineSep=";")
    lines = spark.read.option("lineSep", ";").text(path)
    _same(formats.parse_delimited_lines(lines, "|", table.schema, line_sep=";"))


def test_export_with_sentinels(spark, table):
    path = scratch_path(spark, "lossless-export")
    ingest.export_delimited(table, path, sep="*", null_string="NA", null_non_string=-1000, line_sep=";")
    want = [tuple("NA" if v is None and k in (1, 2, 4) else -1000 if v is None else v for k, v in enumerate(r)) for r in ROWS]
    _same(ingest.read_delimited(spark, path, table.schema, sep="*", line_sep=";"), want)


def test_wrong_number_of_fields_is_an_error(spark, table):
    lines = spark.createDataFrame([("1|a",)], "value string")
    with pytest.raises(PySparkException, match="expected 5 fields"):
        formats.parse_delimited_lines(lines, "|", table.schema).collect()


@pytest.mark.parametrize("sep", ["|", ","])
def test_csv(spark, table, sep):
    _same(formats.convert(table, scratch_path(spark, "lossless-csv"), "csv", "gzip", sep=sep))


def test_json_strings_with_an_empty_column(spark, table):
    path = scratch_path(spark, "lossless-json")
    formats.write_as(formats.to_json_lines(table), path, "text", "gzip")
    _same(formats.cast_to_schema(formats.read_as(spark, path, "json"), table.schema))


def test_absent_column_is_null(spark, table):
    assert formats.cast_to_schema(table.drop("a"), table.schema).where("a IS NOT NULL").count() == 0


@pytest.mark.parametrize("fmt", ["json", "orc", "parquet"])
def test_typed_formats(spark, table, fmt):
    _same(formats.convert(table, scratch_path(spark, f"lossless-{fmt}"), fmt))


@pytest.mark.parametrize("key_first", [True, False])
@pytest.mark.parametrize("new_api", [True, False])
def test_sequence(spark, table, key_first, new_api):
    path = scratch_path(spark, "lossless-sequence")
    sequence.write_sequence(table, path, key_first=key_first, new_api=new_api)
    key = sequence.TEXT if key_first else sequence.NULL_WRITABLE
    _same(sequence.sequence_to_table(sequence.read_sequence(spark, path, new_api=new_api, key_class=key), table.schema, key_first=key_first))


def test_sequence_classes_from_the_files(spark, table):
    path = scratch_path(spark, "lossless-inferred")
    sequence.write_sequence(table, path, codec="bzip2")
    _same(sequence.sequence_to_table(sequence.read_sequence(spark, path, key_class=None), table.schema))


def test_text_key_that_is_null(spark):
    df = spark.createDataFrame([(None, "x"), ("\\N", "y"), ("a|b", None)], "k string, v string")
    path = scratch_path(spark, "lossless-null-key")
    sequence.write_sequence(df, path)
    _same(sequence.sequence_to_table(sequence.read_sequence(spark, path), df.schema), [(None, "x"), ("\\N", "y"), ("a|b", None)])


def test_csv_table_load(spark, table):
    path, name = scratch_path(spark, "lossless-load"), "lossless_load"
    quoting = formats.CSV_QUOTING | {"multiLine": "true"}
    table = table.where("a IS NULL OR a <> '\\\\N'")  # the null mark reads as null here
    formats.write_as(table, path, "csv", "none", sep="|", header="true", **formats.CSV_QUOTING)
    catalog.create_table(spark, name, table.schema, using="csv", options={"sep": "|", "header": "true"} | quoting)
    catalog.load_delimited(spark, name, path, sep="|", header=True, overwrite=True, **quoting)
    _same(spark.table(name), [r for r in ROWS if r[1] != "\\N"])


def test_escape_is_undone(spark):
    texts = ["", "\\", "\\\\", "\\n", "\n", "a;b|c", "\\;\\|", "\\\\n\n\\"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    there = formats.escape(F.col("t"), "|", ";")
    back = df.select("t", there.alias("e"), formats.unescape(there, "|", ";").alias("u")).collect()
    assert [r.u for r in back] == texts
    assert not any(c in r.e for r in back for c in ";|\n\r")
