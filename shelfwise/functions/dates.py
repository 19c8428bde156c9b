"""Date and epoch conversions as built-in Column expressions.

All of these stay inside whole-stage codegen; none needs a Python UDF.
Conversions between epochs and wall-clock values use the session time zone,
as Spark (and Hive before it) does.  Wrap plan construction in
:func:`shelfwise.session.session_time_zone` to pin a zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns the pipelines parse and format with.
DAY_PATTERN = "yyyy-MM-dd"
SECOND_PATTERN = "yyyy-MM-dd HH:mm:ss"
MONTH_PATTERN = "yyyy-MM"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_date(ms) -> Column:
    """``to_date(from_unixtime(ms / 1000))``: epoch milliseconds -> date.

    ``timestamp_millis`` keeps the exact instant; casting ``ms / 1000`` to an
    integer would truncate toward zero and move instants just before 1970
    onto the next second (and date)."""
    return F.to_date(F.timestamp_millis(_c(ms)))


def epoch_ms_to_month(ms) -> Column:
    """``substr(from_unixtime(ms / 1000), 1, 7)``: epoch ms -> 'yyyy-MM'."""
    return F.date_format(F.timestamp_millis(_c(ms)), MONTH_PATTERN)


def timestamp_to_epoch_ms(ts) -> Column:
    """Timestamp (with or without zone) -> epoch milliseconds (bigint)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def epoch_s_to_string(seconds, pattern: str = SECOND_PATTERN) -> Column:
    """``from_unixtime(s)``: epoch seconds -> formatted local time string."""
    return F.from_unixtime(_c(seconds), pattern)


def timestamp_to_epoch_s(ts) -> Column:
    """``unix_timestamp(ts)``: timestamp -> epoch seconds."""
    return F.unix_timestamp(_c(ts).cast("timestamp"))


def parse_to_epoch_s(text, pattern: str = DAY_PATTERN) -> Column:
    """``unix_timestamp(s, pattern)`` that yields null, not an error, for text
    that does not match (old Hive returned 0 or null; ANSI Spark raises)."""
    return F.unix_timestamp(F.try_to_timestamp(_c(text), F.lit(pattern)))


def parse_date(text, pattern: str = DAY_PATTERN) -> Column:
    """``to_date(cast(unix_timestamp(s, pattern) as timestamp))`` in one
    conversion; bad text -> null."""
    return F.try_to_timestamp(_c(text), F.lit(pattern)).cast("date")


def date_part_of(text) -> Column:
    """``to_date('2000-01-01 10:20:30')`` -> 2000-01-01; bad text -> null."""
    return F.try_to_date(_c(text))


def month_key(d) -> Column:
    """Date or timestamp -> 'yyyy-MM'."""
    return F.date_format(_c(d), MONTH_PATTERN)
