"""Benchmark decontamination with a broadcast set of test n-grams.

Words are runs of ASCII digits, ASCII letters (A-Z lowered) and any non-ASCII
character.  A window is ``n`` consecutive words of a benchmark item; an item
with fewer words is one window.  Every window is hashed; the training texts
are scanned once with a rolling window hash per window length, hits are
verified word by word, and the words under any occurrence are marked.

Size bound.  What is broadcast is one block of the benchmark: at most about
``2 * block_bytes`` of normalised item text plus 24 bytes per window.  A
larger benchmark is cut into as many blocks as it needs; the training table
is scanned once per block with the marks carried along in a written table, so
the result is the same and no broadcast grows with the benchmark.

Defined results: a null or empty text has no words and is never contaminated;
a null benchmark text has no windows; rows are independent, so repeated rows
and repeated ids each get their own result; an empty benchmark marks nothing;
a null item id marks words but is not listed among the items.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Slice, Words, byte_table, plain_names, text_slices, window_hashes, words_of, written

WINDOW = 10
BLOCK_BYTES = 8 << 20
PIECE_WORDS = 100_000

_WORD_BYTES = set(range(48, 58)) | set(range(65, 91)) | set(range(97, 123)) | set(range(128, 256))
_SEPARATORS = [b for b in range(256) if b not in _WORD_BYTES]
_TABLE = byte_table(_SEPARATORS)
_PLAIN = bytes(32 if b in set(_SEPARATORS) else b + 32 if 65 <= b <= 90 else b for b in range(256))


_MARKS = (
    T.StructType()
    .add("_n_words", T.LongType())
    .add("_hits", T.ArrayType(T.IntegerType()))
    .add("_items", T.ArrayType(T.StringType()))
)


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text, lower-cased, in order."""
    return (text or "").encode().translate(_PLAIN).split()


def _pieces(rows, n: int):
    """Items as normalised runs of words; long items in runs overlapping by n - 1 words."""
    for batch in rows:
        out = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = normal_words(text)
            step = PIECE_WORDS
            for at in range(0, max(1, len(words) - n + 1), step):
                if run := words[at : at + step + n - 1]:
                    out.append((item, b" ".join(run)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.binary())], ["item", "words"]
        )


class WindowSet:
    """The windows of one benchmark block, findable by hash and verifiable."""

    def __init__(self, rows: list[tuple[str | None, bytes]], n: int):
        self.items = [r[0] for r in rows]
        self.texts = [r[1] for r in rows]
        found: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for k, text in enumerate(self.texts):
            data = np.frombuffer(text, np.uint8)
            words = words_of(Slice(0, 1, data, np.array([0, len(data)])), _TABLE)
            size = min(n, len(words.starts))
            h = window_hashes(words.hashes, size)
            found.setdefault(size, []).append(
                (h, np.full(len(h), k, np.int32), words.starts[: len(h)], words.ends[size - 1 :])
            )
        self.by_size = {}
        for size, parts in sorted(found.items()):
            h, item, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << 20, bool)
            seen[(h >> np.uint64(44)).astype(np.int64)] = True
            self.by_size[size] = (h[order], item[order], start[order], end[order], seen)

    def occurrences(self, part: Slice, words: Words) -> Iterator[tuple[int, int, set]]:
        """(first word, number of words, item ids) of every verified window occurrence in a slice."""
        count = len(words.starts)
        for size, (h, item, start, end, seen) in self.by_size.items():
            if count < size:
                continue
            own = window_hashes(words.hashes, size)
            at = np.flatnonzero(seen[(own >> np.uint64(44)).astype(np.int64)])
            left = np.searchsorted(h, own[at])
            hit = (left < len(h)) & (h[np.minimum(left, len(h) - 1)] == own[at])
            at, left = at[hit], left[hit]
            text_of = np.searchsorted(words.first, at, side="right")
            inside = at + size <= words.first[text_of]
            for i, lo in zip(at[inside].tolist(), left[inside].tolist(), strict=True):
                raw = part.data[words.starts[i] : words.ends[i + size - 1]].tobytes()
                run = b" ".join(raw.translate(_PLAIN).split())
                ids, hi = set(), lo
                matched = False
                while hi < len(h) and h[hi] == own[i]:
                    k = int(item[hi])
                    if self.texts[k][start[hi] : end[hi]] == run:
                        matched = True
                        ids.add(self.items[k])
                    hi += 1
                if matched:
                    yield i, size, ids


def _scan(batches, windows, text_at: int):
    """Append (n_words, hit word numbers, item ids) to every row; earlier marks are merged."""
    held: WindowSet = windows.value
    for batch in batches:
        column = batch.column(text_at)
        total = np.zeros(len(column), np.int64)
        hits: list[np.ndarray] = [np.zeros(0, np.int32)] * len(column)
        items: list[set] = [set()] * len(column)
        for part in text_slices(column):
            words = words_of(part, _TABLE)
            total[part.first : part.last] = np.diff(words.first)
            marked: dict[int, list[int]] = {}
            names: dict[int, set] = {}
            for i, size, ids in held.occurrences(part, words):
                row = int(np.searchsorted(words.first, i, side="right")) - 1
                marked.setdefault(row, []).extend(range(i - words.first[row], i - words.first[row] + size))
                names.setdefault(row, set()).update(x for x in ids if x is not None)
            for row, places in marked.items():
                hits[part.first + row] = np.unique(np.array(places, np.int32))
                items[part.first + row] = names[row]
        at = {name: k for k, name in enumerate(batch.schema.names)}
        if "_hits" in at:
            for row, (h, names) in enumerate(zip(batch.column(at["_hits"]).to_pylist(), batch.column(at["_items"]).to_pylist(), strict=True)):
                if h:
                    hits[row] = np.union1d(hits[row], np.array(h, np.int32)).astype(np.int32)
                if names:
                    items[row] = items[row] | set(names)
        keep = [k for name, k in at.items() if name not in ("_n_words", "_hits", "_items")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in keep), pa.array(total), pa.array(hits, pa.list_(pa.int32())), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
            [*(batch.schema.names[k] for k in keep), "_n_words", "_hits", "_items"],
        )


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    n: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with ``_n_words`` (long), ``_hits`` (word numbers under any
    occurrence of a benchmark window) and ``_items`` (their item ids, as text)."""
    spark = docs.sparkSession
    pieces = (
        benchmark.select(benchmark[item].cast("string"), benchmark[item_text].cast("string"))
        .mapInArrow(lambda rows: _pieces(rows, n), "item string, words binary")
        .distinct()
    )
    pieces = written(pieces, "benchmark-pieces")
    total = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    added = T.StructType([*docs.schema.fields, *_MARKS.fields])
    at = docs.columns.index(text)
    out = docs
    for k in range(blocks):
        block = pieces if blocks == 1 else pieces.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == k)
        held = spark.sparkContext.broadcast(WindowSet([(r[0], bytes(r[1])) for r in block.orderBy("item", "words").collect()], n))
        out = out.mapInArrow(lambda rows, held=held: _scan(rows, held, at), added)
        if k + 1 < blocks:
            out = written(out, "marked")
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: words, words under benchmark windows, items found."""
    text = options.get("text", "text")
    marked = mark(docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias(text)), benchmark, **options)
    return marked.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.size("_hits").cast("long").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("_hits") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, columns unchanged whatever their names."""
    plain, names = plain_names(docs)
    marked = mark(plain, benchmark, **options | {"text": names[options.get("text", "text")]})
    return marked.where(F.size("_hits") == 0).select(*names.values()).toDF(*docs.columns)


def _cut(batches, text_at: int):
    for batch in batches:
        texts = batch.column(text_at).to_pylist()
        hits = batch.column(batch.schema.get_field_index("_hits")).to_pylist()
        column = []
        for value, places in zip(texts, hits, strict=True):
            if not places:
                column.append(value)
                continue
            raw = value.encode()
            words = words_of(Slice(0, 1, np.frombuffer(raw, np.uint8), np.array([0, len(raw)])), _TABLE)
            runs = np.split(np.array(places), np.flatnonzero(np.diff(places) > 1) + 1)
            kept, at = [], 0
            for run in runs:
                kept.append(raw[at : words.starts[run[0]]])
                at = words.ends[run[-1]]
            column.append(b"".join([*kept, raw[at:]]).decode())
        arrays = [batch.column(k) if k != text_at else pa.array(column, pa.string()) for k in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """Every document, the text cut from the first to the last word of each hit run."""
    plain, names = plain_names(docs)
    marked = mark(plain, benchmark, text=names[text], **options)
    at = docs.columns.index(text)
    cut = marked.mapInArrow(lambda rows: _cut(rows, at), marked.schema)
    return cut.select(*names.values()).toDF(*docs.columns)


def items_digest(ids) -> str:
    """SHA-256 of the sorted, comma-joined ids, as ``contamination`` gives it."""
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
