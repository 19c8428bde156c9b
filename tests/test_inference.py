"""Types inferred over whole columns: the lattice, its bounds, and what must stay text."""

import itertools

import pytest
from pyspark.sql import types as T

from shelfwise.sources import formats

INT, LONG, DEC, DBL = T.IntegerType(), T.LongType(), T.DecimalType(38, 0), T.DoubleType()
BOOL, DAY, MOMENT, TEXT = T.BooleanType(), T.DateType(), T.TimestampNTZType(), T.StringType()

CASES = {
    "ints": (["1", "-5", "0", None, ""], INT),
    "int bounds": (["2147483647", "-2147483648"], INT),
    "longs": (["1", "2147483648"], LONG),
    "beyond long": (["9223372036854775808", "-1"], DEC),
    "39 digits": (["1" * 39], TEXT),
    "doubles": (["1", "2.50", "-3e10", "1E-3"], DBL),
    "long and double": (["9223372036854775807", "0.5"], DBL),
    "codes": (["007", "12"], TEXT),
    "signs": (["+1", "2"], TEXT),
    "blank around": ([" 1", "2"], TEXT),
    "minus nothing": (["-", "1"], TEXT),
    "minus zero": (["-0", "1"], DBL),
    "not a number": (["NaN", "1.5"], TEXT),
    "booleans": (["true", "FALSE", ""], BOOL),
    "boolean and int": (["true", "1"], TEXT),
    "days": (["2024-02-29", "1999-01-01"], DAY),
    "no such day": (["2023-02-29"], TEXT),
    "days and moments": (["2024-02-29", "2024-01-01 10:00:00", "2024-01-01T10:00:00.123456"], MOMENT),
    "day and int": (["2024-02-29", "20240229"], TEXT),
    "words": (["a", "1"], TEXT),
    "other digits": (["١٢"], TEXT),
    "nothing": ([None, "", None], TEXT),
}


def _frame(spark, columns):
    rows = list(itertools.zip_longest(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).repartition(3)


def test_lattice(spark):
    df = _frame(spark, {c: v for c, (v, _) in CASES.items()})
    found = formats.infer_schema(df)
    assert {f.name: f.dataType for f in found.fields} == {c: t for c, (_, t) in CASES.items()}


def test_values(spark):
    df = _frame(spark, {"a": ["1", "", "-7"], "b": ["1.5", "2", None], "c": ["2024-02-29", "NULL", ""], "d": ["x", "", "NULL"]})
    got = formats.with_inferred_types(df, nulls=("", "NULL"))
    assert [str(f.dataType) for f in got.schema.fields] == ["IntegerType()", "DoubleType()", "DateType()", "StringType()"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, 1.5, __import__("datetime").date(2024, 2, 29), "x"), (None, 2.0, None, None), (-7, None, None, None)], key=repr
    )


def test_one_late_row_counts(spark):
    df = spark.range(50_000).selectExpr("if(id = 49999, 'x', cast(id as string)) as a", "if(id = 3, '0.5', cast(id as string)) as b")
    assert [f.dataType for f in formats.infer_schema(df).fields] == [TEXT, DBL]


def test_one_pass_without_python(spark):
    df = _frame(spark, {"a": ["1"]})
    empty = formats.infer_schema(df.where("false"))
    assert empty.fields[0].dataType == TEXT


@pytest.mark.parametrize("bits, kind", [(0, TEXT), (1, INT), (3, LONG), (7, DEC), (9, DBL), (16, BOOL), (17, TEXT), (32, DAY), (96, MOMENT), (33, TEXT), (129, TEXT)])
def test_join_of_bits(bits, kind):
    assert formats._join(bits) == kind
