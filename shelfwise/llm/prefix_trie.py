"""A prefix trie of rebuilt conversations by composable fingerprints.

Every conversation is rebuilt from the head of another one and its own suffix.
No rebuilt text is made: the fingerprint of a run of turns is its length and a
sum of ``turn * BASE**place`` modulo a prime, and two runs compose by shifting
the second by a power of the base.  So the fingerprint of every rebuilt prefix is
an expression of three stored numbers: the prefix of the base at the head, and
two prefixes of the conversation itself.  ``LANES`` bases give 124 bits.

Texts are read once and never shuffled: a turn is a SHA-256 of role and text (240
bits of it) and a reference, (conversation, place).  Prefixes of equal depth and
fingerprint are a node; that they are equal is then verified without the
fingerprint, by induction over the depth: all members' references must hold the
same turn, and lead to the same parent.  A node that fails gives other bases.

Prefix sums over a conversation are taken in one range shuffle by (conversation,
turn): each task composes its own rows, one row per task is composed on the
driver, and the results are joined back, so a conversation may fill any number of
tasks.  Joins of conversation data to turns go by blocks of ``BLOCK`` places.

Subtree figures need no walk over the tree.  A node belongs to its smallest
member; the nodes that a conversation owns are a suffix of its path.  Over the
members m of a node, the owner's own figures apart,

* bytes in the subtree with repeats are the sum of m's bytes from the node on;
* bytes in the subtree without repeats are the sum of the bytes that m owns;
* leaves are the sum of the leaves that m owns.

Defined results: rows without a conv_id are left out; null role or text is empty;
turns of one number are ordered by role, then by the hash of the turn, null
numbers first; repeated rows are turns of their own; a base that does not exist
has no turns; an empty table has no node; other columns are not looked at.  The
ids of a node's ended members are hashed one after another in ascending order,
as a SHA-256 must be, streaming from a sorted partition.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import partitions_for, written

PRIME = (1 << 31) - 1
LANES = 4
DIGEST = 4  # numbers of 60 bits each of a turn's SHA-256
BLOCK = 1024
HOT = 1000  # a parent with a larger share of all nodes than one in HOT is broadcast

_TURN = [f"t{k}" for k in range(DIGEST)]
_UP = [f"s{k}" for k in range(LANES)]  # prefix with the turn
_TO = [f"q{k}" for k in range(LANES)]  # prefix before the turn
_KEY = ["depth", "f0", "f1"]


def bases(seed: int) -> list[int]:
    """The base of each lane."""
    return [int(hashlib.sha256(f"{seed}/{k}".encode()).hexdigest()[:12], 16) % (PRIME - 2) + 2 for k in range(LANES)]


def turns(talks: DataFrame) -> DataFrame:
    """conv_id, turn, role, bytes and the hash of every turn."""
    role, text = (F.coalesce(talks[c].cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = talks.where(talks["conv_id"].isNotNull()).select(
        talks["conv_id"].cast("long").alias("conv_id"), talks["turn"].alias("turn"), role.alias("role"), F.octet_length(text).cast("long").alias("bytes"), digest.alias("digest")
    )
    parts = [F.conv(F.substring("digest", 15 * k + 1, 15), 16, 10).cast("long").alias(name) for k, name in enumerate(_TURN)]
    return rows.select("conv_id", "turn", "role", "bytes", *parts)


def _power(base: int, exponents: np.ndarray) -> np.ndarray:
    """``base ** exponents`` modulo the prime."""
    out, square, left = np.ones(len(exponents), np.int64), base, exponents.copy()
    while left.any():
        out = np.where(left & 1, out * square % PRIME, out)
        square, left = square * square % PRIME, left >> 1
    return out


_SCANNED = f"part int, conv_id long, place long, bytes long, total long, {', '.join(f'{c} long' for c in _TURN + _UP + _TO)}"


def _scan(batches, base: list[int]):
    """Place, bytes so far and fingerprints before and after each turn, within this task."""
    from pyspark import TaskContext

    part, last, place, total, sums = TaskContext.get().partitionId(), None, 0, 0, [0] * LANES
    for batch in batches:
        n = batch.num_rows
        conv, size, *digest = (c.to_numpy() for c in batch.columns)
        begins = np.flatnonzero(np.concatenate([[last is None or conv[0] != last], conv[1:] != conv[:-1]]))
        run = np.searchsorted(begins, np.arange(n), side="right") - 1  # -1: goes on from the batch before
        first = np.where(run >= 0, begins[run], 0)
        places = np.arange(n) - first + 1 + np.where(run < 0, place, 0)

        def within(values, carry, run=run, first=first):
            up = np.cumsum(values)
            return up - np.where(run >= 0, (up - values)[first], 0) + np.where(run < 0, carry, 0)

        totals = within(size, total)
        lanes, before = [], []
        for k, b in enumerate(base):
            terms = (digest[k] % (PRIME - 1) + 1) * _power(b, places) % PRIME
            lanes.append(within(terms, sums[k]) % PRIME)
            before.append((lanes[-1] - terms) % PRIME)
        last, place, total, sums = int(conv[-1]), int(places[-1]), int(totals[-1]), [int(lane[-1]) for lane in lanes]
        columns = [np.full(n, part, np.int32), conv, places, size, totals, *digest, *lanes, *before]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["part", "conv_id", "place", "bytes", "total", *_TURN, *_UP, *_TO])


def scanned(rows: DataFrame, base: list[int]) -> DataFrame:
    """Every turn with its place in its conversation, bytes and fingerprints up to it."""
    spark = rows.sparkSession
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), *map(F.col, _TURN)]
    ranged = rows.repartitionByRange(partitions_for(spark), *order).sortWithinPartitions(*order).select("conv_id", "bytes", *_TURN)
    local = written(ranged.mapInArrow(lambda b: _scan(b, base), _SCANNED), "trie-turns")
    ends = local.groupBy("part").agg(F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "place", "total", *_UP)).alias("last"))
    carries, last, run = [], None, (0, 0, [0] * LANES)
    for r in ends.orderBy("part").collect():  # one row per range partition
        if r["first"] == last:
            carries.append((r["part"], last, run[0], run[1], *run[2], *(pow(b, run[0], PRIME) for b in base)))
        if r["last"]["conv_id"] != last:
            last, run = r["last"]["conv_id"], (0, 0, [0] * LANES)
        n = r["last"]["place"]
        run = run[0] + n, run[1] + r["last"]["total"], [(s + pow(b, run[0], PRIME) * r["last"][c]) % PRIME for s, b, c in zip(run[2], base, _UP, strict=True)]
    if not carries:
        return local.drop("part")
    sums, powers = [f"c{k}" for k in range(LANES)], [f"w{k}" for k in range(LANES)]
    carry = spark.createDataFrame(carries, f"part int, conv_id long, n0 long, total0 long, {', '.join(f'{c} long' for c in sums + powers)}")
    joined = local.join(F.broadcast(carry), ["part", "conv_id"], "left")

    def on(column: str, c: str, w: str) -> Column:
        return F.when(F.col("n0").isNull(), F.col(column)).otherwise((F.col(c) + F.col(w) * F.col(column)) % PRIME).alias(column)

    return joined.select(
        "conv_id",
        (F.col("place") + F.coalesce("n0", F.lit(0))).alias("place"),
        "bytes",
        (F.col("total") + F.coalesce("total0", F.lit(0))).alias("total"),
        *_TURN,
        *(on(column, c, w) for columns in (_UP, _TO) for column, c, w in zip(columns, sums, powers, strict=True)),
    )


def _pair(lanes: list[Column]) -> list[Column]:
    """Four lanes as two numbers."""
    return [F.shiftleft(lanes[0], 31) + lanes[1], F.shiftleft(lanes[2], 31) + lanes[3]]


def rebuilt(own: DataFrame, head: Column, base_of: Column, most: int, base: list[int]) -> DataFrame:
    """Every prefix of every rebuilt conversation, the empty one included.

    ``head`` and ``base_of`` are columns of ``conv_id``: how many turns come from
    which conversation, at most ``most``.  Columns: member, depth, the key (f0,
    f1) and the parent's (p0, p1), the last turn's bytes and hash, upto (bytes of
    the prefix), whole (bytes of the rebuilt conversation) and ends (its length).
    """
    talks = own.groupBy("conv_id").agg(F.max("place").alias("n"), F.max("total").alias("all"))
    talks = talks.select(F.col("conv_id").alias("member"), "n", "all", head.cast("long").alias("h"), base_of.alias("of"))
    heads = own.where(F.col("place") <= most).withColumnRenamed("conv_id", "of")
    size = talks.select(F.col("member").alias("of"), F.col("n").alias("base_n"))
    talks = talks.join(size, "of", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    seam = heads.select("of", F.col("place").alias("taken"), F.col("total").alias("head_bytes"), *(F.col(c).alias(f"h{c}") for c in _UP))
    skip = own.where(F.col("place") <= most).select(F.col("conv_id").alias("member"), F.col("place").alias("h"), F.col("total").alias("skip_bytes"), *(F.col(c).alias(f"k{c}") for c in _UP))
    talks = talks.join(seam, ["of", "taken"], "left").join(skip, ["member", "h"], "left")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ["head_bytes", "skip_bytes", *(f"{a}{c}" for a in "hk" for c in _UP)]]
    kept = F.greatest(F.col("n") - F.col("h"), F.lit(0))
    talks = talks.select("member", "of", "h", "taken", "n", "all", *zero)
    talks = talks.withColumn("ends", F.col("taken") + kept).withColumn("whole", F.col("head_bytes") + F.when(F.col("n") > F.col("h"), F.col("all") - F.col("skip_bytes")).otherwise(0))
    talks = written(talks, "trie-conversations")

    def row(depth: Column, up: list[Column], to: list[Column], upto: Column) -> list[Column]:
        f, p = _pair(up), _pair(to)
        return ["member", depth.alias("depth"), f[0].alias("f0"), f[1].alias("f1"), p[0].alias("p0"), p[1].alias("p1"), "bytes", *_TURN, upto.alias("upto"), "whole", "ends"]

    nothing = [F.lit(0).cast("long")] * LANES
    roots = talks.select("member", "whole", "ends", F.lit(0).cast("long").alias("bytes"), *(F.lit(0).cast("long").alias(c) for c in _TURN))
    roots = roots.select(*row(F.lit(0).cast("long"), nothing, nothing, F.lit(0).cast("long")))
    front = talks.where(F.col("taken") > 0).select("member", "of", "taken", "whole", "ends").join(heads, "of").where(F.col("place") <= F.col("taken"))
    front = front.select(*row(F.col("place"), [F.col(c) for c in _UP], [F.col(c) for c in _TO], F.col("total")))
    block = talks.where(F.col("n") > F.col("h")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / BLOCK)))).drop("all", "n")
    back = own.withColumnRenamed("conv_id", "member").withColumn("block", F.floor(F.col("place") / BLOCK)).join(block, ["member", "block"]).where(F.col("place") > F.col("h"))

    def shifted(column: str, k: int, lane: str) -> Column:
        """The head, then the own turns from the seam on, moved ``h - taken`` places to the front."""
        back_by = F.element_at(F.array(*(F.lit(pow(base[k], -i, PRIME)) for i in range(most + 1))), (F.col("h") - F.col("taken") + 1).cast("int"))
        return F.pmod(F.col(f"h{lane}") + (F.col(column) - F.col(f"k{lane}")) * back_by, F.lit(PRIME))

    back = back.select(
        *row(
            F.col("place") - F.col("h") + F.col("taken"),
            [shifted(c, k, c) for k, c in enumerate(_UP)],
            [shifted(c, k, _UP[k]) for k, c in enumerate(_TO)],
            F.col("head_bytes") + F.col("total") - F.col("skip_bytes"),
        )
    )
    return roots.unionByName(front).unionByName(back)


def _hash_ends(batches):
    """SHA-256 of the comma-joined members of each node; rows come sorted by node and member."""
    key, state = None, None

    def out(found):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64()] * 3 + [pa.string()], strict=True)], [*_KEY, "ends_sha256"])

    for batch in batches:
        found = []
        for here, group in itertools.groupby(zip(*(c.to_pylist() for c in batch.columns), strict=True), key=lambda r: r[:3]):
            joined = ",".join(str(r[3]) for r in group).encode()
            if here == key:
                state.update(b"," + joined)
                continue
            if key is not None:
                found.append((*key, state.hexdigest()))
            key, state = here, hashlib.sha256(joined)
        if found:
            yield out(found)
    if key is not None:
        yield out([(*key, state.hexdigest())])


def _owner_of_parent(nodes: DataFrame, total: int) -> DataFrame:
    """(key of a node, owner of its parent); parents of many children by broadcast, the others by shuffle."""
    children = nodes.where(F.col("depth") > 0).select(*_KEY, F.col("depth").alias("cd"), "p0", "p1").withColumn("up", F.col("depth") - 1)
    parents = nodes.select(F.col("depth").alias("up"), F.col("f0").alias("p0"), F.col("f1").alias("p1"), F.col("conv_id").alias("parent_conv_id"), "n_children")
    many = F.col("n_children") * HOT > total  # fewer than HOT rows, as no child has two parents
    on = ["up", "p0", "p1"]
    near = children.join(F.broadcast(parents.where(many).drop("n_children")), on, "left")
    found = near.where(F.col("parent_conv_id").isNotNull())
    rest = near.where(F.col("parent_conv_id").isNull()).drop("parent_conv_id").join(parents.where(~many & (F.col("n_children") > 0)).drop("n_children"), on)
    return found.select(*_KEY, "parent_conv_id").unionByName(rest.select(*_KEY, "parent_conv_id"))


def trie(talks: DataFrame, *, head: Column, base_of: Column, most: int, seed: int = 1) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``head`` and ``base_of`` are expressions over ``conv_id``: the rebuilt
    conversation starts with the first ``head`` (at most ``most``) turns of
    ``base_of`` and goes on with its own turns after its first ``head``.
    """
    rows = turns(talks)
    while True:
        base = bases(seed)
        paths = written(rebuilt(scanned(rows, base), head, base_of, most, base), "trie-paths")
        same = [*_TURN, "p0", "p1"]
        grouped = paths.groupBy(*_KEY).agg(
            F.min("member").alias("conv_id"),
            F.count(F.lit(1)).alias("n_convs"),
            F.first("bytes").alias("bytes"),
            F.first("upto").alias("upto"),
            F.first("p0").alias("p0"),
            F.first("p1").alias("p1"),
            *(f(c).alias(f"{name}_{c}") for c in same for f, name in ((F.min, "least"), (F.max, "most"))),
        )
        differs = F.lit(False)
        for c in same:
            differs = differs | (F.col(f"least_{c}") != F.col(f"most_{c}"))
        nodes = written(grouped.select(*_KEY, "conv_id", "n_convs", "bytes", "upto", "p0", "p1", differs.alias("differs")), "trie-nodes")
        checked = nodes.agg(F.count(F.lit(1)).alias("n"), F.max("differs").alias("bad")).first()
        if not checked["bad"]:
            break
        seed += 1  # two prefixes share a fingerprint: other bases
    children = nodes.where(F.col("depth") > 0).groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("f0"), F.col("p1").alias("f1")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.drop("differs").join(children, _KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long")), "trie-family")
    owned = nodes.groupBy(F.col("conv_id").alias("member")).agg(
        F.sum("bytes").alias("own_bytes"), F.sum((F.col("n_children") == 0).cast("long")).alias("own_leaves")
    )
    lengths = paths.where(F.col("depth") == 0).select("member", "ends")
    owned = lengths.join(owned, "member", "left").select("member", "ends", F.coalesce("own_bytes", F.lit(0)).alias("own_bytes"), F.coalesce("own_leaves", F.lit(0)).alias("own_leaves"))
    blocks = owned.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("ends") / BLOCK)))).drop("ends")
    members = paths.withColumn("block", F.floor(F.col("depth") / BLOCK)).join(blocks, ["member", "block"])
    summed = members.groupBy(*_KEY).agg(
        F.sum("whole").alias("whole"), F.sum("own_bytes").alias("own_bytes"), F.sum("own_leaves").alias("n_leaves"), F.min(F.struct("member", "whole", "own_bytes")).alias("owner")
    )
    ended = paths.where(F.col("depth") == F.col("ends")).select(*_KEY, "member")
    ended = ended.repartition(partitions_for(talks.sparkSession), *_KEY).sortWithinPartitions(*_KEY, "member").mapInArrow(_hash_ends, "depth long, f0 long, f1 long, ends_sha256 string")
    earlier = F.col("upto") - F.col("bytes")  # bytes of the prefix before the node's turn
    repeats = F.col("whole") - F.col("n_convs") * earlier
    once = F.col("own_bytes") - F.col("owner.own_bytes") + F.col("owner.whole") - earlier
    return (
        nodes.join(summed, _KEY)
        .join(ended, _KEY, "left")
        .join(_owner_of_parent(nodes, checked["n"]), _KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            (repeats - once).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )


def conversation_trie(talks: DataFrame, *, stride: int = 5, most: int = 8) -> DataFrame:
    """The trie where the first of every ``stride`` ids is the base of the others and the head is drawn by CRC-32 of the id."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)
    return trie(talks, head=head, base_of=F.col("conv_id") - F.col("conv_id") % stride, most=most)
