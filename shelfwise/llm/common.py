"""Helpers shared by the operators: scratch tables, Arrow text access, hashing.

Texts reach Python as Arrow batches of up to some ten thousand rows.  The
vectorised operators never look at a whole batch at once: ``text_slices``
cuts it into runs of whole rows of about ``SLICE_BYTES``, so the working
memory is a fixed multiple of that (or of the longest single text).
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.session import scratch_path

SLICE_BYTES = 1 << 18


def reachable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    Workers get the folder on their path.  That is all a local master needs; on
    a cluster the package is installed or sent with ``--py-files`` and the
    folder need not exist.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return spark


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a table every executor can read, so a lost executor
    costs a re-read and never an earlier shuffle.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(spark: SparkSession) -> int:
    """The session's shuffle parallelism."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def in_order(df: DataFrame, *order) -> DataFrame:
    """``df`` with ``place``: its row number from 0 in the given order, without a single-task sort."""
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions_for(spark), *order).sortWithinPartitions(*order)
    ranged = written(ranged.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    part = F.shiftrightunsigned("_row", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))  # one row per range partition
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    joined = ranged.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.withColumn("place", F.col("_offset") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))).drop("_row", "_part", "_offset")


def plain_names(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, ... and the new name of each, so that no name
    of a document's column meets one that an operator uses; ``toDF(*docs.columns)`` undoes it."""
    names = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


class Recent:
    """A bounded cache of two generations: what is used again outlives what is not.

    ``young`` is a plain dictionary, so a caller can look many keys up in it at
    once and ask :meth:`get` for those it lacks.
    """

    def __init__(self, limit: int):
        self.limit = limit  # entries of one generation
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.limit:
            self.young, self.old = {}, self.young
        self.young[key] = value


def crc_fold(column: str, modulus: int) -> Column:
    """``crc32(column as text) mod modulus``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


@dataclass
class Slice:
    """Whole texts ``first:last`` of a batch as one byte run."""

    first: int
    last: int
    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than texts, from 0

    def __len__(self) -> int:
        return self.last - self.first


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Runs of whole texts of about ``limit`` UTF-8 bytes; null reads as ''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below ``n``."""
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        n = 1 << max(12, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _POWERS[name] = np.multiply.accumulate(table)
    return _POWERS["up"], _POWERS["down"]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def byte_table(separators: bytes | range | list[int], lower: bool = True) -> np.ndarray:
    """Per byte: 0 for a separator, else the (ASCII-lowered) byte plus 1."""
    table = np.arange(1, 257, dtype=np.uint64)
    if lower:
        table[65:91] += 32
    table[list(separators)] = 0
    return table


@dataclass
class Words:
    starts: np.ndarray  # byte position of each word in the slice
    ends: np.ndarray
    hashes: np.ndarray  # uint64
    first: np.ndarray  # int64, index of each text's first word, one more than texts


def words_of(part: Slice, table: np.ndarray) -> Words:
    """Every word of every text of a slice with its 64-bit hash.

    A word is a maximal run of bytes that ``table`` does not map to 0, within
    one text.  Hashes are differences of prefix polynomials, so the cost is a
    few vector operations per byte whatever the number of distinct words.
    """
    n = len(part.data)
    values = table[part.data]
    inside = np.zeros(n + 2, bool)
    inside[1 : n + 1] = values != 0
    begin = inside[1 : n + 1] & ~inside[:n]
    finish = inside[1 : n + 1] & ~inside[2:]
    cuts = part.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    begin[cuts] = inside[1 : n + 1][cuts]
    finish[cuts - 1] = inside[1 : n + 1][cuts - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    hashes = mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return Words(starts, ends, hashes, np.searchsorted(starts, part.offsets))


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (also across texts)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(hashes) - n + 1, np.uint64(n), np.uint64)
    for k in range(n):
        total = total * np.uint64(0x2545F4914F6CDD1D) + hashes[k : len(hashes) - n + 1 + k]
    return mix64(total)
