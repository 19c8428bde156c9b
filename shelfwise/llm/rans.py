"""Token ids in a binary format: static range asymmetric numeral system coding.

Documents in ascending id order are tokenised, an end id is put after each,
and the ids of consecutive documents fill *segments* of about ``SEGMENT`` ids.
A segment holds

* a header: magic, version, counts, the CRC of everything after it;
* the ids per document;
* one frequency table, scaled to ``2**BITS``, shared by all its blocks;
* blocks of ``BLOCK`` ids, each independent: its ids are dealt in turn to
  ``lanes`` coder states that share one stream of 32-bit words; after every
  ``CHECK`` rounds a checkpoint keeps all states and the place in the stream,
  so a block can be decoded from several places at once; a CRC of its ids.

A segment is one row of a Parquet dataset, so any store Spark can write holds
the files and any task can read any segment.  Order: (part, segment) ascend
with the ids, since parts are range partitions; a row number breaks ties, which
also spreads an id that holds many rows.

Tokenising goes by the ranks of the vocabulary where there are any
(:mod:`shelfwise.llm.byte_bpe`), which keeps nothing between texts.  For other
byte-level vocabularies: a blank before a letter, digit or underscore always
starts a new pre-token, so a text is cut there and every piece is encoded on its
own by the library; the ids of frequent pieces are kept in a bounded cache.

Defined results: a null or empty text has the end id alone; null ids come
first; repeated rows are encoded one by one; an empty table writes no segment.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm import byte_bpe
from shelfwise.llm.common import Recent, partitions_for
from shelfwise.session import scratch_path

MAGIC, VERSION = b"SRNS", 1
BITS = 18
BLOCK = 1 << 20
SEGMENT = 1 << 21
LANES = 4096
CHECK = 128
LOWEST = np.uint64(1 << 31)
END = 2
CACHE = 200_000  # pieces in each of two generations, some 40 MB
KEEP = 64  # longer pieces are not kept

_HEAD = struct.Struct("<4sHHIIQI")  # magic, version, id bytes, documents, blocks, ids, crc of the rest
_BLOCK = struct.Struct("<IIIII")  # ids, lanes, words, checkpoints, crc of the ids
_MARKS = ".,;:!?%$&*#|)]}"  # neither white space, letters nor digits, and in no contraction
_CUT = re.compile(r" (?=\w)", re.ASCII)
_ENCODERS: dict[str, Pieces] = {}


class Pieces:
    """Whole-text tokenisation by cached pieces.

    The new words of a text are put one after another and encoded by the
    library in one call; since a piece starts where a pre-token does, the ids
    of each are found again by the bytes their tokens stand for.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.type = np.dtype("<u2") if max(names.values()) < 1 << 16 else np.dtype("<u4")
        self.width = np.zeros(max(names.values()) + 1, np.int64)
        for name, number in names.items():
            self.width[number] = len(name)  # a character for each byte
        self.known = Recent(CACHE)
        self.tails = Recent(10_000)

    def _encode_apart(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.type).tobytes() for e in self.tokenizer.encode_batch(pieces, add_special_tokens=False)]

    def _encode_joined(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that each follow a blank."""
        if not pieces:
            return []
        ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(pieces)], add_special_tokens=False)[0].ids, self.type)
        ends = np.cumsum(self.width[ids])
        stops = np.cumsum([1 + len(p.encode()) for p in pieces])
        cuts = np.searchsorted(ends, stops) + 1
        if not (ends[cuts - 1] == stops).all():  # a token over a cut: never seen, but then encode one by one
            return self._encode_apart([" " + p for p in pieces])
        raw, size = ids.tobytes(), self.type.itemsize
        return [raw[size * i : size * j] for i, j in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True)]

    @staticmethod
    def _word(piece: str) -> str:
        """The letters of "letters, then marks": the marks are a pre-token of their own."""
        word = piece.rstrip(_MARKS)
        return word if word.isalpha() else piece

    def _tail(self, marks: str) -> bytes:
        known = self.tails.get(marks)
        if known is None:
            known = self._encode_apart([marks])[0]
            self.tails.put(marks, known)
        return known

    def ids(self, text: str) -> bytes:
        """The ids of a text, little-endian."""
        pieces = _CUT.split(text)
        pieces[0] = "\0" + pieces[0]  # no blank before it; other pieces start with a word character
        parts = list(map(self.known.young.get, pieces))
        gaps = [k for k, part in enumerate(parts) if part is None]
        if gaps:
            found = {p: self.known.get(p) for p in {pieces[k] for k in gaps}}
            new = [p for p, part in found.items() if part is None and p[0] != "\0"]
            words = {p: self._word(p) for p in new}
            lacking = [w for w in set(words.values()) if w not in found and self.known.get(w) is None or found.get(w, b"") is None]
            encoded = dict(zip(lacking, self._encode_joined(lacking), strict=True))
            for p, word in words.items():
                ids = encoded.get(word) or self.known.get(word)
                found[p] = ids if word == p else ids + self._tail(p[len(word) :])
            if found.get(pieces[0], b"") is None:
                encoded[pieces[0]] = found[pieces[0]] = self._encode_apart([pieces[0][1:]])[0]
            for p, ids in (found | encoded).items():
                if len(p) <= KEEP:
                    self.known.put(p, ids)
            for k in gaps:
                parts[k] = found[pieces[k]]
        return b"".join(parts)


def scaled(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies adding up to ``2**bits``, at least 1 for every id that occurs."""
    total, room = int(counts.sum()), 1 << bits
    if np.count_nonzero(counts) > room:
        raise ValueError("more distinct ids than the table has room for")
    freq = np.where(counts > 0, np.maximum(1, counts * room // max(1, total)), 0).astype(np.int64)
    over = int(freq.sum()) - room
    if over < 0:
        freq[np.argmax(freq)] -= over
    for k in np.argsort(-freq, kind="stable") if over > 0 else ():
        take = min(over, int(freq[k] // 2))
        freq[k] -= take
        over -= take
        if not over:
            break
    return freq


def encode_block(ids: np.ndarray, freq: np.ndarray, start: np.ndarray) -> bytes:
    """One independent block; ``freq`` and ``start`` are by id, uint64."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 256))
    rounds = -(-n // lanes)
    state = np.full(lanes, LOWEST, np.uint64)
    limit_of = freq << np.uint64(31 - BITS + 32)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    count = 0
    for at in range(rounds - 1, -1, -1):
        symbols = ids[at * lanes : (at + 1) * lanes]
        x = state[: len(symbols)]
        f = freq[symbols]
        full = x >= limit_of[symbols]
        out = x[full].astype(np.uint32)
        words.append(out)
        count += len(out)
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        state[: len(symbols)] = (q << np.uint64(BITS)) + (x - q * f) + start[symbols]
        if at % CHECK == 0:
            marks.append((count, state.copy()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    places = np.array([count - c for c, _ in marks[::-1]], "<u4")
    states = np.concatenate([s for _, s in marks[::-1]]) if marks else np.zeros(0, np.uint64)
    head = _BLOCK.pack(n, lanes, len(stream), len(marks), zlib.crc32(ids.tobytes()))
    return b"".join([head, places.tobytes(), states.astype("<u8").tobytes(), stream.astype("<u4").tobytes()])


class BlockReader:
    """A block found at an offset of a segment; decodes whole or one checkpoint at a time."""

    def __init__(self, data: memoryview, at: int):
        self.n, self.lanes, words, self.marks, self.crc = _BLOCK.unpack_from(data, at)
        at += _BLOCK.size
        self.places = np.frombuffer(data, "<u4", self.marks, at)
        at += 4 * self.marks
        self.states = np.frombuffer(data, "<u8", self.marks * self.lanes, at).reshape(self.marks, self.lanes)
        at += 8 * self.marks * self.lanes
        self.words = np.frombuffer(data, "<u4", words, at)
        self.end = at + 4 * words

    def stretch(self, mark: int, table: Table, out: np.ndarray) -> None:
        """Decode the rounds from one checkpoint to the next into ``out``."""
        place, state = int(self.places[mark]), self.states[mark].astype(np.uint64)
        rounds = -(-self.n // self.lanes)
        low = np.uint64((1 << BITS) - 1)
        for at in range(mark * CHECK, min(rounds, (mark + 1) * CHECK)):
            first = at * self.lanes
            size = min(self.lanes, self.n - first)
            x = state[:size]
            slot = x & low
            symbols = table.symbol[slot.astype(np.int64)]
            out[first : first + size] = symbols
            x = table.freq[symbols] * (x >> np.uint64(BITS)) + slot - table.start[symbols]
            short = np.flatnonzero(x < LOWEST)
            fresh = self.words[place : place + len(short)].astype(np.uint64)
            x[short] = (x[short] << np.uint64(32)) | fresh
            place += len(short)
            state[:size] = x

    def decode(self, table: Table, kind: np.dtype) -> np.ndarray:
        out = np.empty(self.n, kind)
        for mark in range(self.marks):
            self.stretch(mark, table, out)
        if zlib.crc32(out.tobytes()) != self.crc:
            raise ValueError("block checksum does not match")
        return out


class Table:
    """A frequency table laid out for decoding."""

    def __init__(self, present: np.ndarray, freq: np.ndarray):
        size = int(present.max()) + 1 if len(present) else 1
        self.freq, self.start = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[present] = freq
        self.start[present] = np.cumsum(freq) - freq
        self.symbol = np.repeat(present.astype(np.int64), freq.astype(np.int64))


def encode_segment(documents: list[bytes], kind: np.dtype) -> bytes:
    """A segment of documents given as little-endian ids."""
    ids = np.frombuffer(b"".join(documents), kind)
    counts = np.bincount(ids, minlength=1)
    freq = scaled(counts)
    present = np.flatnonzero(freq)
    table = Table(present, freq[present])
    blocks = [encode_block(ids[k : k + BLOCK], table.freq, table.start) for k in range(0, len(ids), BLOCK)]
    lengths = np.array([len(d) // kind.itemsize for d in documents], "<u4")
    body = b"".join(
        [lengths.tobytes(), struct.pack("<I", len(present)), present.astype("<u4").tobytes(), freq[present].astype("<u4").tobytes(), *blocks]
    )
    return _HEAD.pack(MAGIC, VERSION, kind.itemsize, len(documents), len(blocks), len(ids), zlib.crc32(body)) + body


def decode_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids per document, all ids) of a segment; raises if a checksum does not match."""
    magic, version, width, documents, blocks, total, crc = _HEAD.unpack_from(data, 0)
    if magic != MAGIC or version != VERSION or zlib.crc32(memoryview(data)[_HEAD.size :]) != crc:
        raise ValueError("not a segment, or its checksum does not match")
    view, at, kind = memoryview(data), _HEAD.size, np.dtype(f"<u{width}")
    lengths = np.frombuffer(view, "<u4", documents, at)
    at += 4 * documents
    (present,) = struct.unpack_from("<I", view, at)
    at += 4
    table = Table(np.frombuffer(view, "<u4", present, at).astype(np.int64), np.frombuffer(view, "<u4", present, at + 4 * present))
    at += 8 * present
    out = []
    for _ in range(blocks):
        block = BlockReader(view, at)
        out.append(block.decode(table, kind))
        at = block.end
    ids = np.concatenate(out) if out else np.zeros(0, kind)
    if len(ids) != total:
        raise ValueError("segment is incomplete")
    return lengths, ids


def _encoder(vocabulary: str) -> Pieces | byte_bpe.RankEncoder:
    if byte_bpe.has_ranks(vocabulary):
        return byte_bpe.encoder(vocabulary)
    if vocabulary not in _ENCODERS:
        import public_tokenizers

        _ENCODERS[vocabulary] = Pieces(public_tokenizers.path(vocabulary))
    return _ENCODERS[vocabulary]


_FIELDS = ["part", "segment", "before", "n_ids", "doc_ids", "data"]


def _write(batches, vocabulary: str, end: int):
    pieces = _encoder(vocabulary)
    stop = np.array([end], pieces.type).tobytes()
    part, segment, before, held, ids, names, kind = 0, 0, 0, [], 0, [], pa.int64()

    def row():
        values = [[part], [segment], [before], [ids], [names], [encode_segment(held, pieces.type)]]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(kind), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], _FIELDS)

    for batch in batches:
        kind = batch.schema.field(0).type
        for doc_id, text, task in zip(*batch.columns, strict=True):
            part = task.as_py()
            held.append(pieces.ids(text.as_py() or "") + stop)
            names.append(doc_id.as_py())
            ids += len(held[-1]) // pieces.type.itemsize
            if ids >= SEGMENT:
                yield row()
                segment, before, held, ids, names = segment + 1, before + ids, [], 0, []
    if held:
        yield row()


def write_tokens(docs: DataFrame, path: str, *, doc_id: str = "doc_id", text: str = "text", vocabulary: str = "byte_bpe_50k.json", end: int = END) -> None:
    """Tokenise, encode and write ``docs`` in ascending id order as a dataset of segments."""
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"), F.monotonically_increasing_id().alias("_row"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("_row")]
    ranged = rows.repartitionByRange(partitions_for(docs.sparkSession), *order).sortWithinPartitions(*order)
    kind = rows.schema["doc_id"].dataType.simpleString()
    (
        ranged.select("doc_id", "text", F.spark_partition_id().alias("part"))
        .mapInArrow(lambda batches: _write(batches, vocabulary, end), f"part int, segment int, before long, n_ids long, doc_ids array<{kind}>, data binary")
        .write.option("parquet.block.size", 16 << 20)
        .option("compression", "none")
        .parquet(path)
    )


def _digest(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            part, before, names, data = (batch.column(c)[k] for c in range(4))
            lengths, ids = decode_segment(data.as_py())
            ends = np.cumsum(lengths, dtype=np.int64)
            wide = ids.astype("<u4")
            sums = [zlib.crc32(wide[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.as_py()] * n, pa.int32()), names.values, pa.array(before.as_py() + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                ["part", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_digest(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """Read the files back: doc_id, start, n_tokens, ids_crc32 per document."""
    segments = spark.read.schema(f"part int, segment int, before long, n_ids long, doc_ids array<{id_type}>, data binary").parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per range partition
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    found = segments.select("part", "before", "doc_ids", "data").mapInArrow(_digest, f"part int, doc_id {id_type}, within long, n_tokens long, ids_crc32 long")
    return found.join(F.broadcast(offsets), "part").select("doc_id", (F.col("offset") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def encoded_digest(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    """Write ``docs`` to the shared scratch folder and read the files back."""
    path = scratch_path(docs.sparkSession, "token-segments")
    write_tokens(docs, path, doc_id=doc_id, **options)
    return read_digest(docs.sparkSession, path, docs.schema[doc_id].dataType.simpleString())
