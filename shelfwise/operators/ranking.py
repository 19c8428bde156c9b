"""rank() / dense_rank() within groups, without putting a group in one task.

``Window.partitionBy(g).orderBy(v)`` sorts each group in a single task.
When the groups are departments there are a handful of them, each holding a
large share of all products, so one task would sort a fifth of the table.

:func:`rank_within` computes the same numbers from counts:

    rank(v)       = 1 + #rows in the group with a smaller v
    dense_rank(v) = 1 + #distinct smaller v in the group

1. ``hist``: distinct (group, v) with their row counts.  Partial aggregation
   collapses a hot value before the shuffle.
2. Every value gets a bucket number that never falls as the value grows and
   depends on the value alone (:func:`_bucket`): numbers by logarithm, a
   thousandth of their size wide, dates by day, timestamps by hour, texts by
   their first bytes.  Unlike sampled range bounds it comes out the same however
   often a stage is run, so nothing has to be written to pin it and the whole
   ranking is one lazy plan.
3. Inside each (group, bucket) a window computes the counts before each value.
4. Per (group, bucket) totals get a running sum over earlier buckets; adding it
   turns local counts into group counts.  A group has as many of them as its values
   have buckets: some ten thousand for prices, at most 1.5 million for any doubles.
5. The ranks are joined back to the rows on (group, v) with null-safe
   equality.  A (group, v) pair holding a third of the rows is a skewed join
   key with a single row on the other side; AQE's skew-join handling splits
   it.

The input is evaluated twice, for the histogram and for the rows the ranks are
joined to, whatever the size of the groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEPS = 1000  # buckets per factor of e
_PREFIX = 3  # bytes of a text that its bucket is taken from


def _sort_key(c: str, ascending: bool) -> Column:
    # Spark's defaults: ascending sorts nulls first, descending nulls last.
    return F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last()


def _bucket(v: Column, kind: T.DataType, steps: int = STEPS) -> Column:
    """A bucket number (bigint, null for null) that never falls as ``v`` grows; one bucket for types without an order of their own."""
    if isinstance(kind, T.NumericType):
        number = v.cast("double")
        size = F.floor(F.least(F.log1p(F.abs(number)), F.lit(710.0)) * steps).cast("bigint")
        return F.when(F.isnan(number), F.lit(711 * steps)).when(number < 0, -size).when(number >= 0, size)
    if isinstance(kind, T.DateType):
        return F.unix_date(v).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.floor(F.unix_seconds(v) / 3600).cast("bigint")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(v.cast("date")).cast("bigint") * 24 + F.hour(v)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(v.cast("binary"), 1, _PREFIX)), 2 * _PREFIX, "0"), 16, 10).cast("bigint")
    return F.when(v.isNotNull(), F.lit(0)).cast("bigint")


def rank_within(
    df: DataFrame,
    group_cols: list[str],
    order_col: str,
    *,
    ascending: bool = True,
    rank_col: str = "rank",
    dense_rank_col: str = "dense_rank",
    steps: int = STEPS,
) -> DataFrame:
    """Add ``rank_col`` and ``dense_rank_col`` (bigint) to ``df``.

    Same values as ``rank()``/``dense_rank()`` over
    ``partition by group_cols order by order_col``.  Other columns may have any
    names: the histogram has names of its own.
    """
    kind = df.schema[order_col].dataType
    keys = [f"_g{i}" for i in range(len(group_cols))]
    hist = df.groupBy(*[F.col(c).alias(k) for c, k in zip(group_cols, keys, strict=True)], F.col(order_col).alias("_v")).agg(F.count(F.lit(1)).alias("_cnt"))
    placed = hist.withColumn("_bucket", _bucket(F.col("_v"), kind, steps))

    inside = Window.partitionBy(*keys, "_bucket").orderBy(_sort_key("_v", ascending))
    local = placed.withColumn("_rows", F.sum("_cnt").over(inside) - F.col("_cnt")).withColumn("_values", F.row_number().over(inside) - 1)
    totals = placed.groupBy(*keys, "_bucket").agg(F.sum("_cnt").alias("_n"), F.count(F.lit(1)).alias("_d"))
    earlier = Window.partitionBy(*keys).orderBy(_sort_key("_bucket", ascending))
    offsets = totals.select(
        *keys, "_bucket", (F.sum("_n").over(earlier) - F.col("_n")).alias("_rows_before"), (F.sum("_d").over(earlier) - F.col("_d")).alias("_values_before")
    )
    offsets = offsets.select(*[F.col(c).alias(f"_o{c}") for c in offsets.columns])
    same = F.lit(True)
    for c in [*keys, "_bucket"]:
        same = same & local[c].eqNullSafe(offsets[f"_o{c}"])
    ranks = local.join(offsets, same).select(
        *[F.col(c).alias(f"_shelfwise{c}") for c in [*keys, "_v"]],
        (F.col("_rows") + F.col("_o_rows_before") + 1).cast("bigint").alias("_shelfwise_rank"),
        (F.col("_values") + F.col("_o_values_before") + 1).cast("bigint").alias("_shelfwise_dense"),
    )
    same = F.lit(True)
    for c, k in zip([*group_cols, order_col], [*keys, "_v"], strict=True):
        same = same & df[c].eqNullSafe(ranks[f"_shelfwise{k}"])
    return df.join(ranks, same).select(*[df[c] for c in df.columns], ranks["_shelfwise_rank"].alias(rank_col), ranks["_shelfwise_dense"].alias(dense_rank_col))
