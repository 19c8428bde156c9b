"""Quality classification with a factorisation machine.

A text's features are its hashed words (weights scaled to unit length), binned
structure statistics and the binned ``n_chars`` metadata.  The score is
``sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)`` with factors of
rank ``RANK``; the pairwise sum is taken in linear time as
``1/2 sum_f ((sum_i v_if x_i)**2 - sum_i v_if**2 x_i**2)``.

Words are hashed from the byte buffer of a batch, so scoring is a fixed number
of vector operations per byte and one gather per distinct word of a text.

Bounds.  The model is fitted on at most ``sample`` labelled rows, those with
the smallest hashes, a documented parameter; what is collected and broadcast
is bounded by it and by the fixed number of features (10 MB).

Defined results: null and empty texts have no words and get the score their
statistics give; without a labelled row of either kind every score is the
share of label 1 (0.5 without any label); a null label is no label; repeated
rows are scored one by one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Slice, byte_table, crc_fold, text_slices, words_of

BUCKETS = 1 << 18
BINS = 32
RANK = 8
SAMPLE = 8000
MIN_STEPS = 400
THRESHOLD = 0.3
STATISTICS = ("bytes", "n_chars", "words", "word_length", "upper", "digits", "symbols", "stops", "line_words", "same_lines", "new_words", "blanks")
FEATURES = BUCKETS + BINS * len(STATISTICS)

_WORDS = byte_table([9, 10, 11, 12, 13, 32])
_LINES = byte_table([10])
_UPPER, _DIGIT, _SYMBOL, _STOP, _LETTER, _BLANK = (np.zeros(256, bool) for _ in range(6))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_SYMBOL[33:48] = _SYMBOL[58:65] = _SYMBOL[91:97] = _SYMBOL[123:127] = True
_STOP[[44, 46]] = True
_SYMBOL[[44, 46]] = False
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _bins(part: Slice, words, n_chars: np.ndarray, new_words: np.ndarray) -> np.ndarray:
    """Bin number of every statistic of every text."""

    def per_text(flag: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(part.data) + 1, np.int64)
        np.cumsum(flag[part.data], out=sums[1:])
        return np.diff(sums[part.offsets])

    size, count = np.diff(part.offsets), np.diff(words.first)
    lines = words_of(part, _LINES)
    line_count = np.diff(lines.first)
    owner = np.repeat(np.arange(len(size)), line_count).astype(np.uint64)
    pairs = np.unique(np.stack([owner, lines.hashes], axis=1), axis=0) if len(owner) else np.zeros((0, 2), np.uint64)
    kinds = np.bincount(pairs[:, 0].astype(np.int64), minlength=len(size))

    def ratio(a, b):
        return np.divide(a, b, out=np.zeros(len(size)), where=b > 0)

    letters = per_text(_LETTER)
    logs = [np.log2(1.0 + x) for x in (size, n_chars, count)]
    shares = [
        np.sqrt(ratio(a, b)) * (BINS - 1)
        for a, b in ((per_text(_UPPER), letters), (per_text(_DIGIT), size), (per_text(_SYMBOL), size), (per_text(_STOP), count))
    ]
    rest = [np.log2(1.0 + ratio(count, line_count)) * 2, ratio(line_count - kinds, line_count) * (BINS - 1), ratio(new_words, count) * (BINS - 1), ratio(per_text(_BLANK), size) * (BINS - 1)]
    values = [*logs, ratio(letters, count) * 2, *shares, *rest]
    return np.clip(np.stack(values, axis=1), 0, BINS - 1).astype(np.int64)


def features(part: Slice, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, weights, first index of every text) of a slice."""
    words = words_of(part, _WORDS)
    n = len(part)
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(words.first))
    keys, times = np.unique(owner * BUCKETS + (words.hashes >> np.uint64(46)).astype(np.int64), return_counts=True)
    text_of, bucket = keys // BUCKETS, keys % BUCKETS
    kinds = np.bincount(text_of, minlength=n)
    norm = np.sqrt(np.bincount(text_of, weights=times.astype(float) ** 2, minlength=n))
    bins = _bins(part, words, n_chars, kinds) + BUCKETS + BINS * np.arange(len(STATISTICS))
    every = len(STATISTICS)
    first = np.concatenate([[0], np.cumsum(kinds + every)])
    number, weight = np.empty(first[-1], np.int64), np.empty(first[-1], np.float32)
    at = np.arange(len(keys)) + every * text_of
    number[at], weight[at] = bucket, times / norm[text_of]
    stat = (first[1:] - every)[:, None] + np.arange(every)
    number[stat], weight[stat] = bins, 1.0 / np.sqrt(every)
    return number, weight, first[:-1]


class Machine:
    """Weights of a factorisation machine."""

    def __init__(self, bias: float = 0.0, seed: int = 7):
        self.bias = bias
        self.w = np.zeros(FEATURES, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.05, (FEATURES, RANK)).astype(np.float32)

    def terms(self, number, weight, first):
        """Linear parts and factor sums of every text."""
        x = weight[:, None]
        vx = self.v[number] * x
        sums = np.add.reduceat(vx, first)
        linear = np.add.reduceat(self.w[number] * weight, first)
        return linear + 0.5 * ((sums**2).sum(1) - np.add.reduceat((vx**2).sum(1), first)), sums

    def score(self, number, weight, first) -> np.ndarray:
        value = self.bias + self.terms(number, weight, first)[0].astype(float)
        return 1.0 / (1.0 + np.exp(-np.clip(value, -60, 60)))

    def learn(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, rounds: int = 6, batch: int = 128, rate: float = 0.1, decay: float = 1e-5) -> None:
        """Adaptive-gradient descent on the logistic loss, both labels weighing the same."""
        rng = np.random.default_rng(11)
        share = labels.mean()
        worth = np.where(labels > 0, 0.5 / share, 0.5 / (1.0 - share))
        self.bias = 0.0
        rounds = max(rounds, math.ceil(MIN_STEPS * batch / len(rows)))
        seen_w, seen_v, seen_b = np.full(FEATURES, 1e-3, np.float32), np.full((FEATURES, RANK), 1e-3, np.float32), 1e-3
        for _ in range(rounds):
            order = rng.permutation(len(rows))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                number = np.concatenate([rows[i][0] for i in pick])
                weight = np.concatenate([rows[i][1] for i in pick])
                sizes = np.array([len(rows[i][0]) for i in pick])
                first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                value, sums = self.terms(number, weight, first)
                error = (1.0 / (1.0 + np.exp(-np.clip(self.bias + value, -60, 60))) - labels[pick]) * worth[pick] / len(pick)
                owner = np.repeat(np.arange(len(pick)), sizes)
                slope = (error[owner] * weight).astype(np.float32)
                kinds, back = np.unique(number, return_inverse=True)
                by_kind = np.argsort(back, kind="stable")
                cut = np.searchsorted(back[by_kind], np.arange(len(kinds)))
                gw = np.add.reduceat(slope[by_kind], cut) + decay * self.w[kinds]
                pull = slope[:, None] * (sums[owner] - self.v[number] * weight[:, None])
                gv = np.add.reduceat(pull[by_kind], cut) + decay * self.v[kinds]
                seen_w[kinds] += gw**2
                seen_v[kinds] += gv**2
                self.w[kinds] -= rate * gw / np.sqrt(seen_w[kinds])
                self.v[kinds] -= rate * gv / np.sqrt(seen_v[kinds])
                step = float(error.sum())
                seen_b += step**2
                self.bias -= rate * step / np.sqrt(seen_b)


def _lengths(column: pa.Array, texts: pa.Array) -> np.ndarray:
    """The n_chars metadata; a null counts the text's own bytes as unknown: 0."""
    return np.nan_to_num(np.array(column.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=float), nan=0.0).clip(0)


def _extract(batches):
    for batch in batches:
        n_chars = _lengths(batch.column(1), batch.column(0))
        numbers, weights = [], []
        for part in text_slices(batch.column(0)):
            number, weight, first = features(part, n_chars[part.first : part.last])
            numbers += np.split(number.astype(np.int32), first[1:])
            weights += np.split(weight, first[1:])
        yield pa.RecordBatch.from_arrays(
            [batch.column(2), pa.array(numbers, pa.list_(pa.int32())), pa.array(weights, pa.list_(pa.float32()))], ["label", "number", "weight"]
        )


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", label: str = "quality", sample: int = SAMPLE) -> Machine:
    """Fit on the ``sample`` labelled ids of smallest hash; all labels given are training labels.

    An id with several labels has the smallest of them, an id with several
    documents the one of the smallest text hash, and rows are learned in the order of
    their ids' hashes, so the machine does not depend on how the tables are laid out.
    """
    chosen = (
        labels.select(labels[doc_id].alias("_id"), labels[label].cast("int").alias("label"))
        .where("label IN (0, 1) AND _id IS NOT NULL")
        .groupBy("_id")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample)
    )
    picked = docs.select(docs[doc_id].alias("_doc"), F.struct(F.xxhash64(docs[text].cast("string")), docs[text].cast("string").alias("text"), docs[n_chars].cast("double").alias("n_chars")).alias("row"))
    rows = picked.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).groupBy("_id", "label").agg(F.min("row").alias("row"))
    ordered = rows.orderBy(F.xxhash64("_id"), "_id").select("row.text", "row.n_chars", "label")
    got = ordered.mapInArrow(_extract, "label int, number array<int>, weight array<float>").toPandas()
    y = got["label"].to_numpy(float)
    share = (y.sum() + 0.5) / (len(y) + 1.0) if len(y) else 0.5
    machine = Machine(float(np.log(share / (1 - share))))
    if len(y) and 0 < y.sum() < len(y):
        machine.learn([(np.asarray(a, np.int64), np.asarray(b, np.float32)) for a, b in zip(got["number"], got["weight"], strict=True)], y)
    else:
        machine.v[:] = 0
    return machine


def _score(batches, machine, text_at: int, chars_at: int, keep: list[int]):
    held: Machine = machine.value
    for batch in batches:
        n_chars = _lengths(batch.column(chars_at), batch.column(text_at))
        score = np.zeros(batch.num_rows)
        for part in text_slices(batch.column(text_at)):
            score[part.first : part.last] = held.score(*features(part, n_chars[part.first : part.last]))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.array(score)], [*(batch.schema.names[k] for k in keep), "score"])


def score(docs: DataFrame, machine: Machine, *, text: str = "text", n_chars: str = "n_chars", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns of ``docs`` (all by default) with ``score``."""
    keep = docs.columns if keep is None else keep
    held = docs.sparkSession.sparkContext.broadcast(machine)
    at = [docs.columns.index(c) for c in (text, n_chars)]
    kept = [docs.columns.index(c) for c in keep]
    schema = T.StructType([*(docs.schema.fields[k] for k in kept), T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(lambda rows: _score(rows, held, at[0], at[1], kept), schema)


def held_out_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", label: str = "quality") -> DataFrame:
    """Learn from the labels outside the held-out fold, score all documents."""
    machine = fit(docs, labels.where(crc_fold(doc_id, 5) != 0), doc_id=doc_id, text=text, n_chars=n_chars, label=label)
    picked = docs.select(docs[doc_id].alias("doc_id"), (crc_fold(doc_id, 5) == 0).alias("held_out"), docs[text].cast("string").alias("text"), docs[n_chars].cast("double").alias("n_chars"))
    scored = score(picked, machine, keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
