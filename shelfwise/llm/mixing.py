"""Mixing sources to target weights by pivotal dependent rounding.

Targets.  Sources in code-point order (null last) weigh 5, 2, 1, repeating,
and share ``share`` of all words.  A target stops at ``most`` times its
source's size; the excess is reshared by weight until none is above.  The
fixed point is ``least(most * size, level * weight)`` and the level is found
by a few aggregates over the table of sources.

Rounding.  A document is expected ``target / source size`` times: its whole
part is taken as is, the fraction is rounded.  Two documents with fractional
probabilities meet; words are moved from one to the other, in a direction
drawn so that neither's expectation changes, until one probability is 0 or 1.
The other goes on to the next meeting.  Moving words rather than probability
keeps the source's expected words exactly as they were.  Meetings run from long to
short documents.  The one document of a source that is left fractional at the
end is taken by that fraction of its words (``part``), so every source meets
its target to within a word, however long its documents are.

The tree.  Each source is cut by hash into leaves of about ``LEAF`` documents;
every leaf ends with one fractional document; these meet in groups of
``FAN_IN`` leaves, and so on up to one per source.  A level is one grouped
Spark job and no group holds more than a bounded number of rows, whichever
source is hot.

Rows equal in id, source, words and text are one document with a
multiplicity, so a repeated row cannot make a hot leaf.

Defined results: a null or empty text has 0 words and is taken 0 times; a null
source is a source of its own; an empty table gives an empty result.  All
draws come from fixed seeds over hashes of the rows, so reruns agree on any
cluster layout.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import in_order, partitions_for, plain_names, written

WORD = r"[^\x20\x09-\x0D]+"
LEAF = 2000
FAN_IN = 64
RUN = 4096  # repeats of one row that a task writes at a time
SEED = 17
WEIGHTS = (5, 2, 1)
KEY = ["doc_id", "source", "size", "text_hash"]
_UNITS = "doc_id {id}, source string, size long, text_hash long, times long, whole long, extra long, part long, p double, node long, leaf long"


def targets(sizes: DataFrame, *, weights=WEIGHTS, share: float = 1.0, most: float = 3.0) -> DataFrame:
    """From (source, source_size): source, source_size, target (double)."""
    listed = in_order(sizes, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    listed = written(listed.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most))), "sources")
    total = float(listed.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        n, full, open_weight = listed.agg(
            F.count_if(above), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == capped or not open_weight:
            break
        capped, level = n, (total - (full or 0.0)) / open_weight
    return listed.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _meet(p: np.ndarray, size: np.ndarray, draws: np.ndarray) -> int:
    """Round ``p`` in place, one meeting after another; the index left fractional, or -1."""
    at = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if at < 0:
            at = j
            continue
        i = at
        up_i, down_i = (1.0 - p[i]) * size[i], p[i] * size[i]
        up_j, down_j = (1.0 - p[j]) * size[j], p[j] * size[j]
        rise, fall = min(up_i, down_j), min(down_i, up_j)
        if draws[j] * (rise + fall) < fall:  # words move from j to i
            p[i] = 1.0 if up_i <= down_j else p[i] + rise / size[i]
            p[j] = 0.0 if down_j <= up_i else p[j] - rise / size[j]
        else:
            p[i] = 0.0 if down_i <= up_j else p[i] - fall / size[i]
            p[j] = 1.0 if up_j <= down_i else p[j] + fall / size[j]
        at = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return at


def _round_group(pdf: pd.DataFrame, last: bool, seed: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["size", "doc_id", "text_hash"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    name = f"{seed}|{pdf['source'].iat[0]}|{int(pdf['node'].iat[0])}|{len(pdf)}"
    draws = np.random.default_rng(zlib.crc32(name.encode())).random(len(pdf))
    p = pdf["p"].to_numpy(float).copy()
    left = _meet(p, pdf["size"].to_numpy(float), draws)
    pdf["p"], pdf["extra"] = p, (p >= 1.0).astype("int64")
    if left >= 0 and last:
        pdf.loc[left, "part"] = round(p[left] * float(pdf["size"].iat[left]))
    elif left >= 0:
        pdf.loc[left, "extra"] = -1  # still fractional
    return pdf


def _rounder(last: bool, seed: int):
    return lambda pdf: _round_group(pdf, last, seed)


def _round(units: DataFrame, leaves: int, id_type: str, seed: int) -> DataFrame:
    """Settle every unit's fraction level by level."""
    schema = _UNITS.format(id=id_type)
    settled, width, level = None, leaves, 0
    open_units = units.withColumn("node", F.col("leaf"))
    while True:
        last = width <= 1
        done = written(
            open_units.select(*[c.split()[0] for c in schema.split(", ")])
            .groupBy("source", "node")
            .applyInPandas(_rounder(last, seed + level), schema),
            "rounded",
        )
        part = done.where(F.col("extra") >= 0)
        settled = part if settled is None else settled.unionByName(part)
        if last:
            return settled
        open_units = done.where(F.col("extra") < 0).withColumn("node", F.floor(F.col("node") / FAN_IN))
        width, level = math.ceil(width / FAN_IN), level + 1


def mixture(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED, **options) -> DataFrame:
    """Per distinct document (id, source, words, text): ``times`` it occurs,
    whole ``copies`` taken over all its occurrences, words of one more copy
    taken in ``part``, source_size and target."""
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    id_type = docs.schema[doc_id].dataType.simpleString()
    units = written(
        docs.select(
            docs[doc_id].alias("doc_id"), docs[source].cast("string").alias("source"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(body).alias("text_hash")
        )
        .groupBy(*KEY)
        .agg(F.count(F.lit(1)).alias("times")),
        "mixing-units",
    )
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"), F.count(F.lit(1)).alias("units"))
    sizes = written(sizes, "source-sizes")
    wanted = targets(sizes.select("source", "source_size"), **options)
    wanted = wanted.alias("w").join(sizes.alias("s"), F.expr("w.source <=> s.source")).select("w.*", "s.units")
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    expected = F.when(F.abs(each - F.round(each)) < 1e-12, F.round(each)).otherwise(each) * F.col("times")
    leaves = F.greatest(F.lit(1), F.ceil(F.col("units") / LEAF))
    known = (
        units.alias("u")
        .join(wanted.alias("w"), F.expr("u.source <=> w.source"))
        .select("u.*", "w.source_size", "w.target", "w.units")
        .withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(0.0))
        .withColumn("whole", F.floor("expected").cast("long"))
        .withColumn("p", F.col("expected") - F.col("whole"))
        .withColumn("leaf", F.pmod(F.xxhash64("doc_id", "text_hash"), leaves).cast("long"))
        .withColumn("extra", F.lit(-1).cast("long"))
        .withColumn("part", F.lit(0).cast("long"))
    )
    most_units = sizes.agg(F.max("units")).first()[0] or 0
    settled = _round(known.drop("source_size", "target", "units", "expected"), math.ceil(most_units / LEAF), id_type, seed)
    copies = settled.select(*KEY, "times", (F.col("whole") + F.col("extra")).alias("copies"), "part")
    return copies.alias("c").join(wanted.alias("w"), F.expr("c.source <=> w.source")).select("c.*", "w.source_size", "w.target")


def _repeated(rows: DataFrame, times: str, nth: str) -> DataFrame:
    """Every row ``times`` times, numbered from 0 in ``nth``.

    Rows of many repeats are first split into runs of ``RUN``, which are dealt
    out over all tasks, so one row repeated a million times is no task's work alone.
    """
    long = F.col(times) > RUN
    runs = rows.where(long).withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / RUN))))
    runs = runs.repartition(partitions_for(rows.sparkSession), "_run", times)
    runs = rows.where(~long).withColumn("_run", F.lit(0).cast("long")).unionByName(runs)
    first = F.col("_run") * RUN
    each = F.explode(F.sequence(first, F.least(first + RUN, F.col(times)) - 1))
    return runs.where(F.col(times) > 0).withColumn(nth, each).drop("_run")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken,
    and the whole copies and further words it is taken with."""
    mixed = mixture(docs, **options)
    rows = _repeated(mixed, "times", "nth").withColumn("nth", F.col("nth") + 1)
    over = F.col("copies") % F.col("times")
    share = F.floor(F.col("copies") / F.col("times")) + (F.col("nth") <= over).cast("long")
    part = F.when(F.col("nth") == over + 1, F.col("part")).otherwise(0)
    rows = rows.withColumn("copies", share).withColumn("part", part)
    taken = (F.col("size") * F.col("copies") + F.col("part")).cast("long")
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.col("copies").cast("int").alias("copies"), F.col("part").cast("long").alias("part"))


def _whole_residuals(mixed: DataFrame, id_type: str, seed: int) -> DataFrame:
    """``mixed`` with the documents taken in part rounded to whole ones.

    They are one per source; they meet across sources in a tree of their own, so
    that words move from one source's document to another's and the corpus keeps
    its size to within one document, however many sources there are.
    """
    named = mixed.withColumn("unit", F.xxhash64(*KEY))
    parts = named.where("part > 0").select(
        "doc_id", F.lit(None).cast("string").alias("source"), "size", F.col("unit").alias("text_hash"), "times", F.lit(0).cast("long").alias("whole"), F.lit(-1).cast("long").alias("extra"),
        F.lit(0).cast("long").alias("part"), (F.col("part") / F.col("size")).alias("p"),
    )
    parts = written(parts, "mixing-residuals")
    leaves = max(1, math.ceil(parts.count() / LEAF))
    units = parts.withColumn("leaf", F.pmod(F.xxhash64("text_hash"), F.lit(leaves)).cast("long"))
    settled = _round(units, leaves, id_type, seed + 1000)
    draw = F.pmod(F.xxhash64("text_hash", F.lit(seed)), F.lit(1 << 30)) / F.lit(1 << 30)  # for the one left
    more = F.col("extra") + F.when(draw * F.col("size") < F.col("part"), 1).otherwise(0)
    more = settled.select(F.col("text_hash").alias("unit"), more.alias("more"))
    rounded = named.join(more, "unit", "left")
    return rounded.withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).withColumn("part", F.lit(0).cast("long")).drop("unit", "more")


def mix(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: int = SEED, whole: bool = False, **options) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, columns unchanged whatever their names.

    Rows equal in id, source and text are one document here; its other
    columns are those of one of them.  The document a source takes in part
    (at most one) comes with its first words, joined by blanks; if ``whole``, these
    documents meet across sources and are taken whole or not at all.
    """
    columns, (docs, names) = docs.columns, plain_names(docs)
    doc_id, source, text = names[doc_id], names[source], names[text]
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    mixed = mixture(docs, doc_id=doc_id, source=source, text=text, seed=seed, **options)
    if whole:
        mixed = _whole_residuals(mixed, docs.schema[doc_id].dataType.simpleString(), seed)
    mixed = mixed.where("copies > 0 OR part > 0")
    mixed = mixed.select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("text_hash").alias("_hash"), F.col("size").alias("_size"), F.col("copies").alias("_copies"), F.col("part").alias("_part")
    )
    keyed = docs.select(
        "*", docs[doc_id].alias("_k_id"), docs[source].cast("string").alias("_k_source"), F.xxhash64(body).alias("_k_hash"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("_k_size")
    ).dropDuplicates(["_k_id", "_k_source", "_k_hash", "_k_size"])
    same = F.expr("_k_id <=> _id AND _k_source <=> _source AND _k_hash = _hash AND _k_size = _size")
    taken = keyed.join(mixed, same)
    copies = _repeated(taken, "_copies", "_nth") if (mixed.agg(F.max("_copies")).first()[0] or 0) > RUN else taken.withColumn("_nth", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))))
    copies = copies.select(*docs.columns)
    if not whole:
        first = F.array_join(F.slice(F.regexp_extract_all(taken[text], F.lit(WORD), F.lit(0)), F.lit(1), F.col("_part").cast("int")), " ")
        copies = copies.unionByName(taken.where("_part > 0").withColumn(text, first).select(*docs.columns))
    return copies.toDF(*columns)
