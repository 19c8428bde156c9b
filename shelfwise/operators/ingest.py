"""Table import operators: bounds, bounded parallel import, null sentinels,
merge by key, incremental append.

They take the source as a DataFrame, so the same operator serves a JDBC
table (:mod:`shelfwise.sources.jdbc`), a file landing zone or a catalog table.
Only bounded values reach the driver: a (min, max) pair, the last imported
key, or a row per split or key range.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.cleaning import fill_null_sentinels
from shelfwise.session import session_conf
from shelfwise.sources.catalog import create_table, overwrite_partitions, spread_for_partitioned_write
from shelfwise.sources.formats import NULL_MARK, convert, parse_delimited_lines, to_delimited_lines, write_as

RANGE = "key_range"


def key_bounds(df: DataFrame, key: str) -> DataFrame:
    """``select min(key), max(key)`` (the boundary query), one row."""
    return df.agg(F.min(key).alias("min_key"), F.max(key).alias("max_key"))


def bounded_slice(df: DataFrame, key: str, lower, upper) -> DataFrame:
    """Rows with ``lower <= key <= upper`` (``--where``).

    The filter is pushed into the source scan, whose own splits are the
    parallel import tasks (``-m``): nothing is shuffled.
    """
    return df.where(F.col(key).between(lower, upper))


def split_rule(df: DataFrame, key: str, m: int, accuracy: int = 10_000) -> Column:
    """The split, 0 to ``m - 1``, of every row: ranges of ``key`` with equally many rows (``--split-by key -m m``).

    A mergeable quantile sketch gives the ``m - 1`` border values (one row on the
    driver), a second pass counts exactly how many rows lie below and at each of
    them.  A border value that many rows share is itself divided: the rows at it
    go to either side by a hash of the row, in the share that makes the split
    full.  So no value, however frequent, makes a split larger than the others.
    Rows without a key go to the first split.  ``key`` is numeric, a date or a
    timestamp.
    """
    if m <= 1:
        return F.lit(0)
    kind = df.schema[key].dataType.simpleString()
    value = F.col(key)
    shares = [k / m for k in range(1, m)]
    borders = df.agg(F.percentile_approx(value, shares, accuracy).cast(f"array<{kind}>").alias("b")).first()["b"] or []
    if not borders:
        return F.lit(0)
    marks = [F.lit(b).cast(kind) for b in borders]
    counted = df.agg(
        F.count(F.lit(1)),
        *[f for mark in marks for f in (F.count_if(value < mark) + F.count_if(value.isNull()), F.count_if(value == mark))],
    ).first()
    drawn = F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) / F.lit(float(1 << 30))
    split = F.lit(0)
    for k, mark in enumerate(marks):
        below, at = counted[1 + 2 * k], counted[2 + 2 * k]
        left = min(1.0, max(0.0, (counted[0] * shares[k] - below) / at)) if at else 0.0
        split = split + F.coalesce((value > mark) | ((value == mark) & (drawn >= F.lit(left))), F.lit(False)).cast("int")
    return split


def import_in_splits(df: DataFrame, path: str, key: str, m: int, fmt: str = "parquet", compression: str | None = None, **options) -> DataFrame:
    """Import ``df`` with ``m`` tasks, each writing the files of one range of ``key``.

    One folder ``split=k`` per task under ``path``; returns the rows read back,
    with their ``split``.  The split is the task's number, and none is larger than
    another (:func:`split_rule`).  A task holds one split and streams its rows to one
    file: they are not sorted by split first, which would take the memory of a whole split.
    """
    placed = df.withColumn("split", split_rule(df, key, m)).repartitionById(m, F.col("split"))
    with session_conf(df.sparkSession, spark__sql__maxConcurrentOutputFileWriters=m + 1):
        write_as(placed, path, fmt, compression, partitionBy="split", **options)
    return df.sparkSession.read.schema(placed.schema).format(fmt).load(path)


def export_delimited(
    df: DataFrame,
    path: str,
    *,
    sep: str,
    null_string: str,
    null_non_string: int,
    line_sep: str = "\n",
    compression: str | None = None,
) -> str:
    """Write rows as ``sep``-delimited text with null sentinels
    (``--fields-terminated-by``, ``--null-string``, ``--null-non-string``)."""
    filled = fill_null_sentinels(df, null_string, null_non_string)
    write_as(to_delimited_lines(filled, sep, line_sep), path, "text", compression, lineSep=line_sep)
    return path


def read_delimited(spark, path: str, schema, *, sep: str, line_sep: str = "\n") -> DataFrame:
    """Parse text written by :func:`export_delimited` into ``schema``."""
    lines = spark.read.option("lineSep", line_sep).text(path)
    return parse_delimited_lines(lines, sep, schema, line_sep=line_sep)


def merge_by_key(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Newest wins: every row of ``new``, plus the rows of ``old`` whose key
    does not occur in ``new``.

    A left-anti join never multiplies rows, so a key repeated many times on
    either side costs no pair explosion (a full outer join would emit every
    old x new pair of that key).  The keys of ``new`` are made distinct first
    (a partial aggregate), so a repeated key is one row of the right side.
    """
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new)


def create_keyed(df: DataFrame, name: str, key: str, ranges: int) -> str:
    """A catalog table that :func:`merge_into_keyed` can change in place.

    Rows are stored in ``ranges`` partitions of equally many rows, each a range
    of ``key``; the borders are kept as a property of the table.  ``key`` is numeric.
    """
    spark, kind = df.sparkSession, df.schema[key].dataType.simpleString()
    shares = [k / ranges for k in range(1, ranges)]
    borders = df.agg(F.percentile_approx(key, shares or [0.5]).cast(f"array<{kind}>").alias("b")).first()["b"] or []
    borders = sorted(set(borders)) if ranges > 1 else []
    schema = T.StructType([*df.schema.fields, T.StructField(RANGE, T.IntegerType())])
    create_table(spark, name, schema, partitioned_by=[RANGE])
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('key' = '{key}', 'key.type' = '{kind}', 'key.borders' = '{','.join(map(str, borders))}')")
    placed = df.withColumn(RANGE, _range_of(F.col(key), borders, kind))
    spread_for_partitioned_write(placed, [RANGE]).write.insertInto(name)
    return name


def _range_of(key: Column, borders: list, kind: str) -> Column:
    """How many borders are below a key: a search in the sorted borders, null for a null key."""
    listed = F.array(*[F.lit(b).cast(kind) for b in borders]) if borders else F.array().cast(f"array<{kind}>")
    return F.when(key.isNull(), F.lit(-1)).otherwise(F.size(F.filter(listed, lambda b: b < key))).cast("int")


def keyed_rows(spark, name: str) -> DataFrame:
    """The rows of a keyed table without the range they are stored in."""
    return spark.table(name).drop(RANGE)


def merge_into_keyed(spark, name: str, new: DataFrame) -> dict[str, int]:
    """Newest wins, in place: ``new`` replaces the rows of its keys; other files are not touched.

    1. The ranges that hold a key of ``new`` are found from its keys alone (at
       most one number per range reaches the driver).
    2. Of those ranges the key column alone is read (partition pruning on the
       range, the smallest and largest new key as a filter that Parquet's row
       group statistics answer): a range without a common key is only appended to.
    3. Ranges with a common key are read, rid of the new keys by a left-anti join
       and written with the new rows by a dynamic partition overwrite, which
       replaces exactly these folders when all tasks have ended.

    Rows of ``new`` without a key are appended; repeated keys in ``new`` are all
    kept, as :func:`merge_by_key` does.  Returns how many ranges were rewritten,
    appended to, and left alone.
    """
    kept = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    key, kind = kept["key"], kept["key.type"]
    borders = [b for b in kept["key.borders"].split(",") if b]
    columns = keyed_rows(spark, name).columns
    placed = new.select(*columns).withColumn(RANGE, _range_of(F.col(key), borders, kind))
    ends = placed.groupBy(RANGE).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()  # a row per range
    total = len(borders) + 1
    if not ends:
        return {"rewritten": 0, "appended": 0, "kept": total}
    touched = [r[RANGE] for r in ends]
    lows, highs = [r["low"] for r in ends if r["low"] is not None], [r["high"] for r in ends if r["high"] is not None]
    stored = spark.table(name).where(F.col(RANGE).isin(touched))
    between = F.col(key).between(F.lit(min(lows)), F.lit(max(highs))) if lows else F.lit(False)
    new_keys = placed.select(F.col(key).alias("_new_key")).where(F.col("_new_key").isNotNull()).distinct()
    common = stored.where(between).select(RANGE, key).join(new_keys, F.col(key) == F.col("_new_key"), "left_semi")
    shared = sorted(r[0] for r in common.select(RANGE).distinct().collect())
    if shared:
        old = stored.where(F.col(RANGE).isin(shared)).join(new_keys, F.col(key) == F.col("_new_key"), "left_anti")
        changed = old.unionByName(placed.where(F.col(RANGE).isin(shared)))
        overwrite_partitions(spread_for_partitioned_write(changed.select(*columns, RANGE), [RANGE]), name)
    fresh = [k for k in touched if k not in shared]
    if fresh:
        spread_for_partitioned_write(placed.where(F.col(RANGE).isin(fresh)).select(*columns, RANGE), [RANGE]).write.insertInto(name)
    return {"rewritten": len(shared), "appended": len(fresh), "kept": total - len([k for k in touched if k >= 0])}


def last_value(target: DataFrame, key: str):
    """The largest key already imported (None for an empty target)."""
    return target.agg(F.max(key)).first()[0]


def rows_after(source: DataFrame, key: str, last) -> DataFrame:
    """``--incremental append --check-column key --last-value last``."""
    if last is None:
        return source
    return source.where(F.col(key) > F.lit(last))


def content_hash(df: DataFrame) -> list[Column]:
    """Aggregates that tell the rows of a table apart from any others, in any order:
    the sum (exact) and the exclusive or of a 64-bit hash of every row."""
    row = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit(NULL_MARK)) for c in df.columns], *[F.col(c).isNull() for c in df.columns])
    return [F.count(F.lit(1)).alias("n_rows"), F.sum(row.cast("decimal(38,0)")).alias("row_sum"), F.bit_xor(row).alias("row_xor")]


def import_verified(sources: dict[str, DataFrame], path_of, fmt: str = "parquet", compression: str | None = "snappy", side_by_side: int = 4) -> DataFrame:
    """Import several tables at a time and compare each with its source.

    ``path_of`` names the target folder of a table.  The imports are submitted side by side, so
    small tables fill the cluster while a large one ends.  One row per table: table_name, n_rows (of the target) and
    ``same``, whether source and target hold the same rows, each as often.
    """
    def copy(name: str) -> DataFrame:
        return convert(sources[name], path_of(name), fmt, compression)

    with ThreadPoolExecutor(side_by_side) as pool:
        copies = dict(zip(sources, pool.map(copy, sources), strict=True))
    report = None
    for name, source in sources.items():
        there = copies[name].agg(*content_hash(copies[name]))
        here = source.agg(*content_hash(source)).select(*[F.col(c).alias(f"source_{c}") for c in ("n_rows", "row_sum", "row_xor")])
        same = F.lit(True)
        for c in ("n_rows", "row_sum", "row_xor"):
            same = same & F.col(c).eqNullSafe(F.col(f"source_{c}"))
        row = there.join(F.broadcast(here)).select(F.lit(name).alias("table_name"), "n_rows", same.alias("same"))  # one row beside one row
        report = row if report is None else report.unionByName(row)
    return report
