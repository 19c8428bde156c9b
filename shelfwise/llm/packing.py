"""Packing token sequences by non-negative least squares.

Documents are tokenised, an end id is put after each, and everything beyond
whole windows of ``window`` ids is a *rest* of 1 to window - 1 ids.  Only the
histogram of rests decides how they are combined:

* shallow combinations are enumerated: repeats of one or two lengths, or three
  different lengths, that fill a window exactly;
* how often to use each is the non-negative least squares problem
  ``min |A x - histogram|, x >= 0``, solved by coordinate descent that always
  steps along the best column, so the solution uses few columns;
* the counts are rounded down to what the histogram holds;
* what is left is packed greedily, whole runs of equal windows at a time, the
  longest length first and then each time the longest that still fits.  A length
  that leaves a hole of more than ``slack`` ids is put aside; the pieces put aside
  are laid end to end and cut where a window ends, so they leave no hole at all.

The plan is a table of rank ranges per length: its size depends on the number of
lengths, not of documents, so it is solved on the driver and sent to the tasks.
Documents get their rank within a length from one range shuffle of (length, row),
without their ids: task offsets are summed from a row per task, so a length that a
third of all documents have is spread over as many tasks as its rows need.  The
ids are written once and moved once, to be joined with the ranks.

Defined results: a null or empty text is the end id alone; rows of one id are
separate documents; a null id stays null; sequences shorter than a window are to
be padded; other columns are not looked at; an empty table gives no piece.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.byte_bpe import encoder
from shelfwise.llm.common import partitions_for, written

WINDOW = 1024
SLACK = 8
ROUNDS = 1500
WIDTH = 256  # columns tried in a round
FLUSH = 4 << 20  # bytes of ids held before a batch goes out


def combinations(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, repeats) of every shallow combination that fills the window; unused places are 0."""
    lengths = np.unique(lengths[(lengths > 0) & (lengths < window)]).astype(np.int64)
    have = np.zeros(window + 1, bool)
    have[lengths] = True
    found = []
    for a in lengths.tolist():
        for times in range(1, window // a + 1):
            gap = window - times * a
            if gap == 0:
                found.append(np.array([[a, 0, 0, times, 0, 0]]))
                continue
            share = np.arange(1, gap // (a + 1) + 1)  # the other length is longer
            share = share[gap % share == 0]
            other = gap // share
            share, other = share[have[other]], other[have[other]]
            none = np.zeros(len(other), np.int64)
            found.append(np.stack([none + a, other, none, none + times, share, none], 1))
        middle = lengths[(lengths > a) & (2 * lengths < window - a)]
        last = window - a - middle
        middle, last = middle[have[last]], last[have[last]]
        ones, none = np.ones(len(middle), np.int64), np.zeros(len(middle), np.int64)
        found.append(np.stack([none + a, middle, last, ones, ones, ones], 1))
    table = np.concatenate(found) if found else np.zeros((0, 6), np.int64)
    return table[:, :3], table[:, 3:]


def repeat_counts(lengths: np.ndarray, repeats: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares: how often each combination is used, not rounded.

    Every round steps along the columns of the largest gain that have no length in
    common, each to its own minimum.
    """
    x = np.zeros(len(lengths))
    if not len(lengths):
        return x
    left, norm = histogram.astype(float), (repeats * repeats).sum(1).astype(float)
    left[0] = 0
    pull, near = np.sqrt(norm), 1e-5 * histogram.max()
    for _ in range(rounds):
        step = np.maximum((repeats * left[lengths]).sum(1) / norm, -x)
        gain = np.abs(step) * pull
        best = np.argpartition(-gain, min(WIDTH, len(x)) - 1)[:WIDTH]
        best = best[np.argsort(-gain[best], kind="stable")]
        if gain[best[0]] < max(0.5, near):
            break
        touched = {0}
        for k, mine in zip(best.tolist(), lengths[best].tolist(), strict=True):
            if gain[k] < max(0.5, near) or not touched.isdisjoint(n for n in mine if n):
                continue
            touched.update(mine)
            x[k] += step[k]
            left[mine] -= repeats[k] * step[k]
        left[0] = 0
    return x


def rounded(x: np.ndarray, lengths: np.ndarray, repeats: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Whole counts no larger than ``x`` that the histogram can serve."""
    left, counts = histogram.astype(np.int64).copy(), np.zeros(len(x), np.int64)
    for k in np.argsort(-x, kind="stable"):
        wanted = int(x[k] + 1e-6)
        if not wanted:
            break
        used = repeats[k] > 0
        counts[k] = min(wanted, int((left[lengths[k][used]] // repeats[k][used]).min()))
        left[lengths[k][used]] -= counts[k] * repeats[k][used]
    return counts


def plan(histogram: np.ndarray, window: int = WINDOW, slack: int = SLACK) -> tuple[np.ndarray, int]:
    """Where every rest goes, and the number of sequences.

    Rows (rest, first rank, end rank, first sequence, offset): one sequence for
    each rank from the first on; or, with offset -1, ranks laid end to end from
    the start of the sequence plus ``rest`` ids a rank.  The fourth number is then
    a position in ids.
    """
    left, used = {n: c for n, c in enumerate(histogram.tolist()) if n and c}, dict.fromkeys(range(window), 0)
    rows, sequence = [], 0

    def place(need: dict[int, int], count: int) -> None:
        """``count`` equal sequences of so many pieces of each length."""
        nonlocal sequence
        at = 0
        for n, times in need.items():
            for _ in range(times):
                rows.append((n, used[n], used[n] + count, sequence, at))
                used[n], at = used[n] + count, at + n
            left[n] -= times * count
            if not left[n]:
                del left[n]
        sequence += count

    lengths, repeats = combinations(np.flatnonzero(histogram), window)
    counts = rounded(repeat_counts(lengths, repeats, histogram), lengths, repeats, histogram)
    for k in np.flatnonzero(counts):
        place({n: times for n, times in zip(lengths[k].tolist(), repeats[k].tolist(), strict=True) if times}, int(counts[k]))
    aside, order = [], sorted(left)
    while order:
        hole, need = window, {}
        k = len(order)
        while (k := bisect_right(order, hole, 0, k) - 1) >= 0:
            n = order[k]
            need[n] = min(hole // n, left[n])
            hole -= n * need[n]
        if hole <= slack:
            place(need, min(left[n] // times for n, times in need.items()))
            order = [n for n in order if n in left]
        else:
            aside.append(order.pop())
    start = sequence * window
    for n in aside:
        rows.append((n, used[n], used[n] + left[n], start, -1))
        start += n * left[n]
    return np.array(rows, np.int64).reshape(-1, 5), -(-start // window)


class Places:
    """The plan looked up by rest and rank."""

    def __init__(self, rows: np.ndarray, window: int):
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        self.window, self.of = window, {}
        for rest in np.unique(rows[:, 0]).tolist():
            mine = rows[rows[:, 0] == rest]
            self.of[rest] = mine[:, 1].tolist(), mine[:, [1, 3, 4]].tolist()

    def pieces(self, rest: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(first id, ids, sequence, offset) of every piece of a rest."""
        firsts, runs = self.of[rest]
        first, at, offset = runs[bisect_right(firsts, rank) - 1]
        if offset >= 0:
            return [(0, rest, at + rank - first, offset)]
        sequence, offset = divmod(at + (rank - first) * rest, self.window)
        here = min(rest, self.window - offset)
        return [(0, here, sequence, offset)] + ([(here, rest - here, sequence + 1, 0)] if here < rest else [])


def _tokenise(batches, vocabulary: str, end: int, window: int):
    from pyspark import TaskContext

    coder, row = encoder(vocabulary), TaskContext.get().partitionId() << 40
    stop = np.array([end], coder.type).tobytes()

    def out(names, held, kind):
        sizes = np.array([len(h) for h in held], np.int64) // coder.type.itemsize
        columns = [pa.array(names, kind), pa.array(row + np.arange(len(held))), pa.array(sizes), pa.array(sizes % window), pa.array(held, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n", "rest", "ids"])

    for batch in batches:
        names, held, size = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            names.append(doc_id.as_py())
            held.append(coder.ids(text.as_py() or "") + stop)
            size += len(held[-1])
            if size >= FLUSH:
                yield out(names, held, batch.column(0).type)
                row += len(held)
                names, held, size = [], [], 0
        if names:
            yield out(names, held, batch.column(0).type)
            row += len(held)


def _number(batches, window: int):
    from pyspark import TaskContext

    part, place, chunks = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        full = batch.column(1).to_numpy() // window
        before = chunks + np.cumsum(full) - full
        n = batch.num_rows
        extra = [pa.array(np.full(n, part, np.int32)), pa.array(place + np.arange(n)), pa.array(before)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *extra], ["row", "n", "rest", "part", "place", "chunks"])
        place, chunks = place + n, chunks + int(full.sum())


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _pieces(batches, rows: np.ndarray, below: np.ndarray, offsets: dict[int, tuple[int, int]], window: int, with_ids: bool):
    places = Places(rows, window)

    def out(found, held, kind):
        columns = list(zip(*found, strict=True))
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(held, pa.binary())] if with_ids else arrays, [*_NAMES, "ids"] if with_ids else _NAMES)

    for batch in batches:
        kind, found, held, size = batch.column(0).type, [], [], 0
        for doc_id, raw, n, rest, part, place, chunk in zip(*batch.columns, strict=True):
            doc_id, n, rest, raw, part = doc_id.as_py(), n.as_py(), rest.as_py(), raw.as_py(), part.as_py()
            first_place, first_chunk = offsets[part]
            ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4").tobytes()
            spans = [(k * window, window, first_chunk + chunk.as_py() + k, 0) for k in range(n // window)]
            if rest:
                rank = first_place + place.as_py() - int(below[rest])
                spans += [(n - rest + a, size_, sequence, at) for a, size_, sequence, at in places.pieces(rest, rank)]
            for start, length, sequence, at in spans:
                cut = ids[4 * start : 4 * (start + length)]
                found.append((doc_id, start, length, zlib.crc32(cut), n, sequence, at))
                if with_ids:
                    held.append(cut)
                size += 4 * length
            if size >= FLUSH:
                yield out(found, held, kind)
                found, held, size = [], [], 0
        if found:
            yield out(found, held, kind)


def pack(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    end: int = 0,
    window: int = WINDOW,
    slack: int = SLACK,
    with_ids: bool = True,
) -> DataFrame:
    """Every piece of every document with its place in a sequence: doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset and, ``with_ids``, its ids as little-endian 32-bit integers."""
    spark = docs.sparkSession
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, row long, n long, rest long, ids binary"
    tokens = written(rows.mapInArrow(lambda b: _tokenise(b, vocabulary, end, window), shape), "pack-tokens")
    ranged = tokens.select("row", "n", "rest").repartitionByRange(partitions_for(spark), "rest", "row").sortWithinPartitions("rest", "row")
    placed = written(ranged.mapInArrow(lambda b: _number(b, window), "row long, n long, rest long, part int, place long, chunks long"), "pack-places")
    histogram, below, offsets = np.zeros(window, np.int64), np.zeros(window, np.int64), {}
    for r in placed.groupBy("rest").count().collect():  # at most one row per length
        histogram[r["rest"]] = r["count"]
    below[1:] = np.cumsum(histogram)[:-1]
    table, at_chunk = plan(np.where(np.arange(window) > 0, histogram, 0), window, slack)
    at_place = 0
    sums = placed.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.floor(F.col("n") / window)).alias("chunks"))
    for r in sums.orderBy("part").collect():  # one row per range partition
        offsets[r["part"]] = at_place, at_chunk
        at_place, at_chunk = at_place + r["rows"], at_chunk + r["chunks"]
    shape = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids binary" if with_ids else "")
    joined = tokens.select("doc_id", "row", "ids").join(placed, "row").select("doc_id", "ids", "n", "rest", "part", "place", "chunks")
    return joined.mapInArrow(lambda b: _pieces(b, table, below, offsets, window, with_ids), shape)
