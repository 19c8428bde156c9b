"""Casts, null handling and delimited-text splitting as Column expressions.

ANSI mode is on in Spark 4: ``cast('12.5' as int)`` and ``'150.5' > 100``
raise.  The helpers go through ``double`` and ``try_cast`` so dirty input
becomes null instead of failing the job.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The null sentinels of the reference's import
# (strings become 'NA', every other type -1000).
NULL_STRING_SENTINEL = "NA"
NULL_NON_STRING_SENTINEL = -1000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_float(c) -> Column:
    """String -> float; unparsable -> null."""
    return _c(c).try_cast("float")


def to_int(c) -> Column:
    """String -> int by truncation ('12.5' -> 12); unparsable -> null."""
    return _c(c).try_cast("double").try_cast("int")


def empty_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every empty string becomes null (string columns only)."""
    targets = set(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    return df.select(
        *[
            F.nullif(F.col(f.name), F.lit("")).alias(f.name) if f.name in targets else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def fill_null_sentinels(
    df: DataFrame,
    string_sentinel: str = NULL_STRING_SENTINEL,
    other_sentinel: int = NULL_NON_STRING_SENTINEL,
) -> DataFrame:
    """Replace nulls: string columns by ``string_sentinel``, numeric columns by
    ``other_sentinel``; other types are cast to string first (as a text export
    would print them) and get the non-string sentinel."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            cols.append(F.coalesce(c, F.lit(string_sentinel)).alias(f.name))
        elif isinstance(f.dataType, T.NumericType):
            cols.append(F.coalesce(c, F.lit(other_sentinel).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.coalesce(c.cast("string"), F.lit(str(other_sentinel))).alias(f.name))
    return df.select(*cols)


def split_first(line, sep: str, names: tuple[str, str] = ("key", "value")) -> list[Column]:
    """``line.split(sep, 1)``: key before the first separator, rest after (null if there is none)."""
    parts = F.split(_c(line), re.escape(sep), 2)
    return [F.get(parts, F.lit(0)).alias(names[0]), F.get(parts, F.lit(1)).alias(names[1])]
