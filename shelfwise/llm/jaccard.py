"""N-gram Jaccard join by vertical partitioning.

A document's set is its distinct shingles of ``shingle`` words; sets of Jaccard
similarity at least ``percent`` / 100 are linked, and links make components.
The shingles of the whole corpus have one global order, that of a 64-bit hash.

Candidates.  The order is cut into fragments, so every set falls into one
segment per fragment.  Two linked sets of sizes a and b differ in at most
``D = (a + b) * (100 - percent) / (100 + percent)`` shingles, and each of those
spoils one fragment.  Sets are put in classes of similar size; with ``D + 1 +
SPARE`` fragments for the largest D of a class, more than ``SPARE`` segments
of a linked pair are identical.  A set therefore gives one key per segment (of
its own class, and of the next one if it can link there), leaving out empty
segments unless it has more than ``SPARE`` of them, and linked sets meet in a
bucket of equal keys.  Identical sets are one set from the start.

Counting.  A candidate pair's overlap is counted per fragment of a coarse cut
of the same order, each on its own, and the partial counts are summed per pair.
Before that, a sketch of one byte per fine fragment bounds it: two segments
whose bytes differ hold at least one shingle that is not shared, so a pair with
more unequal bytes than D cannot link.  The bound is certain, never a guess.

Which pairs.  Only components are asked for, so no bucket is expanded into all
its pairs.  In a few rounds the members of a bucket are put in an order;
neighbours of different components are counted and the links found merge
components.  Orders change from round to round.  Then the pairs still open --
members of a bucket outside its largest component, against members of other
components -- are all bounded by their sketches, in blocks of at most about
``CHUNK`` by ``CHUNK`` members, and those the bound leaves are counted.  No
pair that might link is left out.

How the work is spread.  Keys and set numbers are shuffled, 16 bytes each.
Shingles are only shuffled for sets that share a bucket: a broadcast bitmap of
fixed size (8 MB) keeps most others out of the shuffle, the join the rest.  The
sets are kept in a table bucketed by set number.  A set with very many pairs is
salted.  Components of links come from alternating star contractions, which
only join and group (with map-side combining), over written tables.

Defined results: null, empty and blank texts have the empty set, linked with
nothing; a text of fewer words than a shingle has one, its whole sequence;
repeated rows are in one component; a component without any non-null id has a
null component id.  Sets are numbered by 64 bits of a cryptographic hash.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Slice, byte_table, mix64, partitions_for, plain_names, text_slices, window_hashes, words_of, written
from shelfwise.session import unique_name

SHINGLE = 3
PERCENT = 90
SPARE = 2
COARSE = 8
BITS = 26
FAN_OUT = 1000
ROUNDS = 2
CHUNK = 1024

_TABLE = byte_table([9, 10, 11, 12, 13, 32])


def shingle_sets(part: Slice, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a slice."""
    words = words_of(part, _TABLE)
    runs = window_hashes(words.hashes, size)
    out = []
    for first, last in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if last - first >= size:
            out.append(np.unique(runs[first : last - size + 1]))
        else:
            out.append(window_hashes(words.hashes[first:last], last - first) if last > first else np.zeros(0, np.uint64))
    return out


def set_number(shingles: np.ndarray) -> int | None:
    """64 bits that stand for a non-empty set."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


class Classes:
    """Size classes and the fragment borders of each."""

    def __init__(self, percent: int = PERCENT):
        self.low, self.high = percent, 100 - percent
        self.starts = [1]
        self.borders: dict[int, np.ndarray] = {}

    def _grow(self, n: int) -> None:
        while self.starts[-1] <= n:
            self.starts.append(max(self.starts[-1] + 1, math.ceil(self.starts[-1] * (100 / self.low) ** 3)))

    def of(self, n: int) -> list[int]:
        """Its own class, and the next if a set of ``n`` can link to one in there."""
        self._grow(n)
        own = int(np.searchsorted(self.starts, n, side="right")) - 1
        return [own, own + 1] if 100 * n >= self.low * self.starts[own + 1] else [own]

    def differences(self, number: int) -> int:
        """The most shingles in which two linked sets of the class can differ."""
        self._grow(self.starts[-1] if number + 1 >= len(self.starts) else 0)
        return 2 * (self.starts[number + 1] - 1) * self.high // (100 + self.low)

    def cut(self, number: int) -> np.ndarray:
        """First hash of every fragment but the first."""
        if number not in self.borders:
            n = self.differences(number) + 1 + SPARE
            self.borders[number] = np.array([(k << 64) // n for k in range(1, n)], np.uint64)
        return self.borders[number]


def segment_keys(shingles: np.ndarray, classes: Classes) -> np.ndarray:
    """Keys under which a set meets every set it may link to, other than itself."""
    out = []
    sums = np.zeros(len(shingles) + 1, np.uint64)
    np.cumsum(mix64(shingles), out=sums[1:])
    for number in classes.of(len(shingles)):
        if not classes.differences(number):
            continue
        cuts = np.concatenate([[0], np.searchsorted(shingles, classes.cut(number)), [len(shingles)]])
        held = np.diff(cuts)
        keys = mix64(sums[cuts[1:]] - sums[cuts[:-1]] + mix64(np.arange(len(held), dtype=np.uint64) + np.uint64(number << 32)))
        out.append(keys if (held == 0).sum() > SPARE else keys[held > 0])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _number(batches, at: int, keep: list[int], shingle: int):
    for batch in batches:
        numbers: list = []
        sizes: list = []
        for part in text_slices(batch.column(at)):
            for s in shingle_sets(part, shingle):
                numbers.append(set_number(s))
                sizes.append(len(s))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keep), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64())], [*(batch.schema.names[k] for k in keep), "_set", "_size"]
        )


def numbered(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with ``_set`` and ``_size``."""
    keep = docs.columns if keep is None else keep
    kept = [docs.columns.index(c) for c in keep]
    at = docs.columns.index(text)
    fields = [docs.schema.fields[k] for k in kept]
    schema = T.StructType([*fields, T.StructField("_set", T.LongType()), T.StructField("_size", T.LongType())])
    return docs.mapInArrow(lambda rows: _number(rows, at, kept, shingle), schema)


def _segments(batches, percent: int, shingle: int):
    classes, seen = Classes(percent), set()  # a copy gives nothing new: one per task
    for batch in batches:
        for part in text_slices(batch.column(0)):
            keys, owners = [], []
            for s in shingle_sets(part, shingle):
                number = set_number(s)
                if number is None or number in seen:
                    continue
                seen.add(number)
                keys.append(segment_keys(s, classes))
                owners.append(np.full(len(keys[-1]), number, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners))], ["key", "set"])


def _wanted_sets(batches, bitmap, shingle: int):
    bits, seen = bitmap.value, set()
    for batch in batches:
        for part in text_slices(batch.column(0)):
            numbers, segments, sizes, sketches = [], [], [], []
            for s in shingle_sets(part, shingle):
                number = set_number(s)
                if number is None or number in seen:
                    continue
                slot = number & ((1 << BITS) - 1)
                if not int(bits[slot >> 6]) >> (slot & 63) & 1:
                    continue
                seen.add(number)
                numbers.append(number)
                sizes.append(len(s))
                sketches.append(sketch(s))
                cuts = np.searchsorted(s, [np.uint64((k << 64) // COARSE) for k in range(1, COARSE)])
                segments.append([x.view(np.int64) for x in np.split(s, cuts)])
            if numbers:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()), pa.array(segments, pa.list_(pa.list_(pa.int64())))],
                    ["set", "size", "sketch", "segments"],
                )


def sketch(shingles: np.ndarray) -> bytes:
    """One byte per fine fragment, a power of two of them: the exclusive or of its shingles' bytes."""
    fragments = 1 << max(3, round(math.log2(max(8, len(shingles) / 2))))
    out = np.zeros(fragments, np.uint8)
    at = (shingles >> np.uint64(64 - fragments.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    out[at[first]] = np.bitwise_xor.reduceat((mix64(shingles) >> np.uint64(56)).astype(np.uint8), first)
    return out.tobytes()


def folded(rows: np.ndarray, fragments: int) -> np.ndarray:
    """Sketches (one per row) as they would be with fewer fragments."""
    while rows.shape[1] > fragments:
        rows = rows[:, ::2] ^ rows[:, 1::2]
    return rows


def may_link(sizes, sketches, other_sizes, other_sketches, percent: int) -> np.ndarray:
    """For every pair of rows, whether their sketches leave room for a link.

    Both sides come as sizes and matrices of sketches, one pair per row (or
    one row on one side, for all rows of the other).
    """
    fragments = min(sketches.shape[1], other_sketches.shape[1])
    unequal = (folded(sketches, fragments) != folded(other_sketches, fragments)).sum(axis=1)
    total = sizes + other_sizes
    fits = 100 * np.minimum(sizes, other_sizes) >= percent * np.maximum(sizes, other_sizes)
    return fits & (unequal * (100 + percent) <= total * (100 - percent))


def _bitmap(sets: DataFrame) -> np.ndarray:
    """Bits of the numbers in ``sets``, by their low BITS bits."""
    slot = F.col("set").bitwiseAND(F.lit((1 << BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = sets.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toPandas()
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def components(edges: DataFrame) -> DataFrame | None:
    """(node, component): the smallest node of each component of (u, v) edges; None without edges.

    Alternating star contractions: every node hands its larger neighbours to its
    smallest one, then its smaller ones, until only stars are left.
    """
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    state = None
    while True:
        edges = written(edges, "edges")
        n, digest = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if not n:
            return None
        if (n, digest) == state:
            break
        state = (n, digest)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        pair = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        edges = small.select(pair.alias("e")).select("e.u", "e.v").where("u <> v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _matrix(sketches: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)


def _bounded_pairs(batches, percent: int):
    """Of rows (a, b, size_a, sketch_a, size_b, sketch_b) those that may link."""
    for batch in batches:
        a, b, size_a, size_b = (batch.column(k).to_numpy() for k in (0, 1, 2, 4))
        sketch_a, sketch_b = batch.column(3).to_pylist(), batch.column(5).to_pylist()
        kinds = np.array([len(x) * 65536 + len(y) for x, y in zip(sketch_a, sketch_b, strict=True)])
        keep = np.zeros(len(a), bool)
        for kind in np.unique(kinds):
            at = np.flatnonzero(kinds == kind)
            keep[at] = may_link(size_a[at], _matrix([sketch_a[k] for k in at]), size_b[at], _matrix([sketch_b[k] for k in at]), percent)
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def _open_pairs(batches, percent: int):
    """Of sorted rows (key, block, other_block, asked, set, component, size,
    sketch) the pairs of asked and other rows of a group that may link."""

    def pairs(rows):
        asked = [r for r in rows if r[3]]
        by_length: dict[int, list] = {}
        for r in rows:
            if not r[3]:
                by_length.setdefault(len(r[7]), []).append(r)
        for members in by_length.values():
            sets, parts, sizes = (np.array([m[k] for m in members]) for k in (4, 5, 6))
            matrix = _matrix([m[7] for m in members])
            for q in asked:
                keep = (parts != q[5]) & may_link(q[6], _matrix([q[7]]), sizes, matrix, percent)
                yield from ((min(q[4], s), max(q[4], s)) for s in sets[keep].tolist())

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    group, held, found = None, [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != group:
                found += pairs(held)
                group, held = row[:3], []
            held.append(row)
        if found:
            yield out(found)
            found = []
    if held:
        yield out(list(pairs(held)))


def _count_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of candidate pairs (a, b) those that link."""
    spread = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / FAN_OUT).cast("int").alias("salts"))
    left = spread.join(sets, F.col("a") == F.col("set")).select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("segments").alias("left"))
    right = (
        pairs.join(spread, "a")
        .withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
        .join(sets, F.col("b") == F.col("set"))
        .select("a", "b", "salt", F.col("segments").alias("right"))
    )
    partial = F.zip_with("left", "right", lambda x, y: F.size(F.array_intersect(x, y)))
    total = lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x)
    size = lambda c: total(F.transform(c, F.size))
    counted = left.join(right, ["a", "salt"]).select("a", "b", total(partial).alias("both"), (size("left") + size("right")).alias("sum"))
    return counted.where(F.lit(100) * F.col("both") >= F.lit(percent) * (F.col("sum") - F.col("both"))).select("a", "b")


class _Linker:
    """Links between sets that share buckets, found round by round."""

    def __init__(self, members: DataFrame, sets: DataFrame, percent: int):
        self.members, self.sets, self.percent = members, sets, percent
        self.part_of = members.select("set").distinct().select("set", F.col("set").alias("component"))

    def open_members(self) -> DataFrame:
        """Members of buckets that still hold more than one component."""
        bucket = Window.partitionBy("key")
        placed = self.members.join(self.part_of, "set")
        ends = placed.withColumn("lo", F.min("component").over(bucket)).withColumn("hi", F.max("component").over(bucket))
        return ends.where("lo <> hi").drop("lo", "hi")

    def merge(self, pairs: DataFrame) -> bool:
        """Count pairs (a, b) that their sketches allow; whether that merged components."""
        links = _count_pairs(written(pairs, "pairs"), self.sets, self.percent)
        names = self.part_of
        edges = (
            links.join(names.select(F.col("set").alias("a"), F.col("component").alias("u")), "a")
            .join(names.select(F.col("set").alias("b"), F.col("component").alias("v")), "b")
            .select("u", "v")
        )
        merged = components(edges)
        if merged is not None:
            moved = names.join(merged, names["component"] == merged["node"], "left")
            self.part_of = written(moved.select("set", F.coalesce(merged["component"], names["component"]).alias("component")), "components")
        return merged is not None

    def bounded(self, pairs: DataFrame) -> DataFrame:
        """Those of some pairs (a, b) that their sketches allow, each once."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        short = self.sets.select("set", "size", "sketch")
        for side in "ab":
            pairs = pairs.join(short.select(F.col("set").alias(side), F.col("size").alias(f"size_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)
        return pairs.select("a", "b", "size_a", "sketch_a", "size_b", "sketch_b").mapInArrow(lambda rows, percent=self.percent: _bounded_pairs(rows, percent), "a long, b long")

    def open_pairs(self) -> DataFrame:
        """Pairs of a bucket's members outside its largest component with
        members of other components that may link.

        A bucket is cut into blocks on both sides, and one group holds one
        block of either.
        """
        left = written(self.open_members(), "open-buckets")
        sizes = left.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        largest = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.max("n").alias("most"), F.sum("n").alias("all"))
        blocks = largest.select("key", "main", F.ceil(F.col("all") / CHUNK).cast("int").alias("blocks"), F.ceil((F.col("all") - F.col("most")) / CHUNK).cast("int").alias("asked_blocks"))
        placed = left.join(blocks, "key").join(self.sets.select("set", "size", "sketch"), "set")
        own = lambda n, seed: F.pmod(F.xxhash64("set", F.lit(seed)), n).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        row = ["set", "component", "size", "sketch"]
        others = placed.select("key", own(F.col("blocks"), 1).alias("block"), every(F.col("asked_blocks")).alias("asked_block"), F.lit(False).alias("asked"), *row)
        asked = placed.where("component <> main").select("key", every(F.col("blocks")).alias("block"), own(F.col("asked_blocks"), 2).alias("asked_block"), F.lit(True).alias("asked"), *row)
        group = ["key", "block", "asked_block"]
        return others.unionByName(asked).repartition(*group).sortWithinPartitions(*group).mapInArrow(lambda rows, percent=self.percent: _open_pairs(rows, percent), "a long, b long").distinct()

    def run(self) -> DataFrame:
        for turn in range(ROUNDS):
            order = [F.col("set")] if turn == 0 else [F.xxhash64("set", "key", F.lit(turn)), F.col("set")]
            row = Window.partitionBy("key").orderBy(*order)
            beside = self.open_members().select("set", "component", F.lag("set").over(row).alias("a"), F.lag("component").over(row).alias("other"))
            if not self.merge(self.bounded(beside.where("a IS NOT NULL AND other <> component").select("a", F.col("set").alias("b")))):
                break
        self.merge(self.open_pairs())
        return self.part_of


def linked_sets(docs: DataFrame, *, text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(set, component) of all sets that may link to another."""
    spark = docs.sparkSession
    body = docs.select(docs[text].cast("string").alias("text"))
    keyed = body.mapInArrow(lambda rows: _segments(rows, percent, shingle), "key long, set long")
    bucket = Window.partitionBy("key")
    shared = keyed.withColumn("lo", F.min("set").over(bucket)).withColumn("hi", F.max("set").over(bucket)).where("lo <> hi")
    members = written(shared.select("key", "set").distinct(), "buckets")
    bitmap = spark.sparkContext.broadcast(_bitmap(members.select("set").distinct()))
    count = min(50_000, partitions_for(spark))
    table = unique_name("shingle_sets")
    (
        body.mapInArrow(lambda rows: _wanted_sets(rows, bitmap, shingle), "set long, size long, sketch binary, segments array<array<long>>")
        .repartition(count, "set")
        .dropDuplicates(["set"])
        .write.bucketBy(count, "set")
        .saveAsTable(table)
    )
    try:
        return _Linker(members, spark.table(table), percent).run()
    finally:
        spark.sql(f"DROP TABLE {table}")


def join_components(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    rows = written(numbered(picked, keep=["doc_id"], shingle=shingle), "sets-of-documents")
    return _with_component(rows, linked_sets(picked, percent=percent, shingle=shingle)).select("doc_id", F.col("_size").alias("n_shingles"), "component_id")


def _with_component(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` (doc_id, _set, ...) with component_id; the smallest id per set is found first, so copies never travel."""
    least = rows.where("_set IS NOT NULL").groupBy("_set").agg(F.min("doc_id").alias("least"))
    least = least.join(linked, least["_set"] == linked["set"], "left").select("_set", "least", F.coalesce("component", "_set").alias("component"))
    least = written(least, "least-of-set")
    names = least.groupBy("component").agg(F.min("least").alias("component_id"))
    by_set = least.join(names, "component").select("_set", "component_id")
    joined = rows.join(by_set, "_set", "left")
    return joined.withColumn("component_id", F.when(F.col("_set").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One document of every component, that of the smallest id, columns unchanged whatever their names; empty sets all stay."""
    columns, (docs, names) = docs.columns, plain_names(docs)
    doc_id, text = names[doc_id], names[text]
    picked = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    rows = written(numbered(picked, keep=["doc_id"], shingle=shingle), "sets-of-documents")
    linked = linked_sets(picked, percent=percent, shingle=shingle)
    known = rows.where("_set IS NOT NULL").distinct()
    placed = known.join(linked, known["_set"] == linked["set"], "left").withColumn("component", F.coalesce("component", "_set"))
    first = placed.groupBy("component").agg(F.min_by(F.struct("doc_id", "_set"), F.struct(F.col("doc_id").isNull(), "doc_id", "_set")).alias("first"))
    first = written(first.select(F.col("first.doc_id").alias("_first"), F.col("first._set").alias("_first_set")), "first-of-component")
    all_rows = numbered(docs, text=text, shingle=shingle)
    chosen = all_rows.where("_set IS NOT NULL").withColumn("_k", F.col(doc_id)).dropDuplicates(["_k", "_set"])
    chosen = chosen.join(first, F.expr("_k <=> _first AND _set = _first_set"), "left_semi")
    return chosen.select(*docs.columns).unionByName(all_rows.where("_set IS NULL").select(*docs.columns)).toDF(*columns)
