"""Approximate nearest neighbours by query-aware collision counting.

Every vector, scaled to unit length, is projected on ``projections`` random
lines.  Per line the projections are kept as one sorted array.  A query centres
a window on its own projection on every line; a vector inside collides there.
Windows widen by the factor ``widen`` (virtual rehashing: only the newly covered
ends of the arrays are read) until a share ``enough`` of the block (and at
least ``LEAST`` vectors, if it has them) collide on at least ``share`` of the
lines.  Those are verified by exact cosine in double precision.

How the work is spread.  Vectors are dealt into blocks of about ``BLOCK`` rows
and queries into blocks of about ``QUERIES``, both by a hash of the row number,
so equal ids or equal vectors cannot gather.  One task indexes one block and
answers one query block on it; the best ``k`` of every block meet per query.
No task holds more than one block of either, whatever the table's size, and
nothing is broadcast.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component take no part, others do however large or small their
components are; vectors of other lengths are not compared;
a row with the query's own id is no candidate; equal cosines rank by smaller
id; with fewer than ``k`` candidates all are returned; an empty table gives an
empty result.  Null ids take no part (they cannot be queried or named).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import written

BLOCK = 8192
QUERIES = 2048
PROJECTIONS = 96
SHARE = 0.75
ENOUGH = 0.025
LEAST = 128
START = 0.4
WIDEN = 1.25


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows times a power of two that brings their largest component to [0.5, 1).

    That changes no bit of a cosine, and squares neither vanish nor overflow."""
    _, exponent = np.frexp(np.abs(vectors).max(1))
    return np.ldexp(vectors, -exponent[:, None])


class SortedProjections:
    """The index of one block of vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, projections: int = PROJECTIONS, seed: int = 3):
        self.vectors, self.ids = vectors, ids = scaled(vectors), ids
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.lines = np.random.default_rng(seed).normal(size=(vectors.shape[1], projections))
        at = ((vectors / self.norms[:, None]) @ self.lines).T
        self.order = np.argsort(at, axis=1, kind="stable")
        self.sorted = np.take_along_axis(at, self.order, axis=1)

    def search(self, queries: np.ndarray, owns: np.ndarray, k: int, share: float = SHARE, enough: float = ENOUGH, at_once: int = 256):
        """Per query the (id, cosine) of its best ``k`` verified vectors."""
        for first in range(0, len(queries), at_once):
            yield from self._search(queries[first : first + at_once], owns[first : first + at_once], k, share, enough)

    def _search(self, queries, owns, k, share, enough):
        n, lines, queries = len(self.ids), len(self.sorted), scaled(queries)
        norms = np.sqrt((queries * queries).sum(1))
        centres = ((queries / norms[:, None]) @ self.lines).T
        need, least = min(n, k + 1 + max(LEAST, math.ceil(enough * n))), math.ceil(share * lines)
        low = np.stack([np.searchsorted(row, c) for row, c in zip(self.sorted, centres, strict=True)])
        high = low.copy()
        hits = np.zeros((len(queries), n), np.int64)
        answers, open_, width = [None] * len(queries), list(range(len(queries))), START
        while open_:
            near = centres[:, open_]
            lo = np.stack([np.searchsorted(row, c - width) for row, c in zip(self.sorted, near, strict=True)])
            hi = np.stack([np.searchsorted(row, c + width) for row, c in zip(self.sorted, near, strict=True)])
            still = []
            for at, q in enumerate(open_):
                ends = zip(self.order, lo[:, at].tolist(), low[:, q].tolist(), high[:, q].tolist(), hi[:, at].tolist(), strict=True)
                fresh = [piece for row, a, b, c, d in ends for piece in (row[a:b], row[c:d])]
                hits[q] += np.bincount(np.concatenate(fresh), minlength=n)
                low[:, q], high[:, q] = lo[:, at], hi[:, at]
                found = np.flatnonzero(hits[q] >= least)
                if len(found) >= need or (not lo[:, at].any() and (hi[:, at] == n).all()):
                    answers[q] = self._verify(found, queries[q], norms[q], owns[q], k)
                else:
                    still.append(q)
            open_, width = still, width * WIDEN
        return answers

    def _verify(self, found, query, norm, own, k) -> list[tuple[int, float]]:
        cosine = (self.vectors[found] * query).sum(1) / (self.norms[found] * norm)
        ids = self.ids[found]
        other = ids != own
        cosine, ids = cosine[other], ids[other]
        best = np.lexsort((ids, -cosine))[:k]
        return list(zip(ids[best].tolist(), cosine[best].tolist(), strict=True))


def _answer(k: int):
    def answer(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(block) and len(asked):
            block = block.sort_values("row")
            index = SortedProjections(np.stack(block["vector"].to_numpy()).astype(np.float64), block["vec_id"].to_numpy())
            answers = index.search(np.stack(asked["vector"].to_numpy()).astype(np.float64), asked["vec_id"].to_numpy(), k)
            for row, own, found in zip(asked["row"], asked["vec_id"], answers, strict=True):
                out += [(row, own, i, c) for i, c in found]
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"])

    return answer


def nearest(
    table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5, block: int = BLOCK, queries: int = QUERIES
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of every row whose id is divisible by ``every``."""
    finite = F.forall("vector", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = (
        table.select(table[vec_id].cast("long").alias("vec_id"), table[vector].cast("array<double>").alias("vector"))
        .where(F.col("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("length", F.size("vector"))
    )
    rows = written(rows, "vectors")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    blocks = max(1, math.ceil(rows.count() / block))
    asked_blocks = max(1, math.ceil(asked.count() / queries))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("q", spread(asked_blocks))
    right = asked.withColumn("q", F.pmod(F.xxhash64("row"), F.lit(asked_blocks)).cast("int")).withColumn("b", spread(blocks))
    found = (
        left.groupBy("length", "b", "q")
        .cogroup(right.groupBy("length", "b", "q"))
        .applyInPandas(_answer(k), "row long, query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
