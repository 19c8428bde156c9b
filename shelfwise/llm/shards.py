"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points on a 64-bit ring.  A row's key hashes
to a place on the ring and belongs to the shard of the next point clockwise.
Under the law ``bytes`` no shard may hold more than ``(1 + slack)`` times the
mean size: what overflows a full shard continues clockwise to the next shard
with room.  Under the law ``key`` there is no bound, so id and shard count
alone decide, and one more shard takes rows only into itself.

How the work is spread.  The ring is cut into ``CELLS`` equal cells.  Spark
sums the sizes per cell; the driver places cells, never rows:

* a row of at least ``mean / UNIT`` bytes is placed on its own.  Sizes add up
  to ``shards * mean``, so there are at most ``shards * UNIT`` such rows;
* all other rows of a cell move together.  A cell that holds more than
  ``mean / UNIT`` bytes (repeated ids) is cut into sub-cells by row number,
  at most ``2 * shards * UNIT`` of them in all.

So the driver sees at most ``CELLS + 3 * shards * UNIT`` numbers whatever the
size of the table, and the placement that is broadcast has the same bound.
Should granularity leave no shard with room for a unit, it goes to the
emptiest one.

Slots count the rows of a shard from 0 without gaps: rows are numbered within
(shard, scan split) and offset by the counts of the splits before.

Defined results: a null text has no bytes and CRC 0; null ids share one place
on the ring (and its sub-cells); repeated rows are kept and numbered one by
one; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import mix64, written

CELL_BITS = 16
CELLS = 1 << CELL_BITS
UNIT = 1024
OVERHEAD = 16


def _ring(shards: int, virtual_nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ring points in cell numbers, ascending, and the shard of each; a shard's points do not depend on the count."""
    shard, copy = (x.ravel() for x in np.meshgrid(np.arange(shards, dtype=np.uint64), np.arange(virtual_nodes, dtype=np.uint64), indexing="ij"))
    points = mix64(mix64(shard + np.uint64(0x51ED270B)) + copy)
    order = np.argsort(points, kind="stable")
    return (points[order] >> np.uint64(64 - CELL_BITS)).astype(np.int64), shard[order].astype(np.int64)


def owners(shards: int, virtual_nodes: int) -> np.ndarray:
    """The shard that owns each cell: that of the first point at or after the cell."""
    points, shard = _ring(shards, virtual_nodes)
    return shard[np.searchsorted(points, np.arange(CELLS)) % len(points)]


class _Placer:
    """Bounded-load placement of units that each start at a cell."""

    def __init__(self, shards: int, virtual_nodes: int, capacity: float):
        self.points, self.shard = (x.tolist() for x in _ring(shards, virtual_nodes))
        self.load = [0] * shards
        self.capacity = capacity

    def place(self, cell: int, size: int) -> int:
        load, room = self.load, self.capacity - size
        emptiest = min(range(len(load)), key=load.__getitem__)
        chosen = emptiest
        if load[emptiest] <= room:
            at = bisect.bisect_left(self.points, cell) % len(self.points)
            while load[self.shard[at]] > room:
                at = (at + 1) % len(self.points)
            chosen = self.shard[at]
        load[chosen] += size
        return chosen


def _sub(count) -> F.Column:
    return F.pmod(F.xxhash64("row"), count).cast("int")


def shard(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shards: int = 40,
    law: str = "bytes",
    virtual_nodes: int = 128,
    slack: float = 0.001,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    if law not in ("bytes", "key"):
        raise ValueError(f"unknown law {law!r}")
    spark = docs.sparkSession
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = written(
        docs.select(
            docs[doc_id].alias("doc_id"),
            (F.octet_length(body) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(docs[doc_id]), 64 - CELL_BITS).cast("int").alias("cell"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    if law == "key":
        table = {"cell": np.arange(CELLS, dtype=np.int32), "at": owners(shards, virtual_nodes).astype(np.int32), "grown": owners(shards + 1, virtual_nodes).astype(np.int32)}
        placed = rows.join(F.broadcast(spark.createDataFrame(pa.table(table))), "cell").withColumnsRenamed({"at": "shard", "grown": "grown_shard"})
    else:
        placed = _bounded(rows, shards, virtual_nodes, slack).withColumn("grown_shard", F.lit(None).cast("int"))
    placed = placed.withColumn("split", F.shiftrightunsigned("row", 33))
    counts = placed.groupBy("shard", "split").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "split").orderBy("row"))
    return placed.withColumn("within", within).join(offsets, ["shard", "split"]).select(
        "doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"), "grown_shard"
    )


def _bounded(rows: DataFrame, shards: int, virtual_nodes: int, slack: float) -> DataFrame:
    spark = rows.sparkSession
    total = rows.agg(F.sum("size")).first()[0] or 0
    unit = max(1, total // (shards * UNIT))
    place = _Placer(shards, virtual_nodes, (1 + slack) * total / shards).place
    large = rows.where(F.col("size") >= unit) if total else rows.limit(0)
    big = sorted(((r["size"], r["cell"], r["row"]) for r in large.select("size", "cell", "row").collect()), reverse=True)
    alone = pa.table({"row": pa.array([b[2] for b in big], pa.int64()), "own": pa.array([place(b[1], b[0]) for b in big], pa.int32())})
    small = rows.where(F.col("size") < unit)
    loads = {r["cell"]: r["load"] for r in small.groupBy("cell").agg(F.sum("size").alias("load")).collect()}
    cuts = {cell: -(-load // unit) for cell, load in loads.items() if load > 2 * unit}
    units = [(load, cell, 0) for cell, load in loads.items() if cell not in cuts]
    if cuts:
        hot = spark.createDataFrame(pa.table({"cell": pa.array(list(cuts), pa.int32()), "parts": pa.array(list(cuts.values()), pa.int32())}))
        split = small.join(F.broadcast(hot), "cell").groupBy("cell", _sub(F.col("parts")).alias("sub")).agg(F.sum("size").alias("load"))
        units += [(r["load"], r["cell"], r["sub"]) for r in split.collect()]
    homes = {cell: [0] * cuts.get(cell, 1) for cell in loads}
    for load, cell, sub in sorted(units, reverse=True):
        homes[cell][sub] = place(cell, load)
    cells = spark.createDataFrame(
        pa.table({"cell": pa.array(list(homes), pa.int32()), "homes": pa.array(list(homes.values()), pa.list_(pa.int32()))})
    )
    return (
        rows.join(F.broadcast(spark.createDataFrame(alone)), "row", "left")
        .join(F.broadcast(cells), "cell", "left")
        .withColumn("shard", F.coalesce("own", F.get("homes", _sub(F.size("homes")))))
        .drop("own", "homes")
    )
