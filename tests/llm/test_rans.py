"""Exact round trips of the token format, and the digest against the library."""

import random
import struct
import zlib

import numpy as np
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from shelfwise.llm import rans
from shelfwise.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
KIND = np.dtype("<u2")


def _want(docs):
    at, out = 0, {}
    rows = sorted((r for r in docs.select("doc_id", "text").collect()), key=lambda r: (r.doc_id is not None, r.doc_id))
    for r in rows:
        ids = TOKENIZER.encode(r.text or "", add_special_tokens=False).ids + [2]
        out.setdefault(r.doc_id, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        at += len(ids)
    return out, at


def _check(docs, rows):
    want, total = _want(docs)
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    at = 0
    for r in sorted(rows, key=lambda r: r.start):  # no gap, ids ascending, nulls first
        assert r.start == at
        at += r.n_tokens
    assert at == total
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order)


def test_pieces_give_the_whole_text():
    pieces, rng = rans.Pieces(PATH), random.Random(1)
    odd = ["", " ", "\n", " \n a", "a 　 b  c\x1c d\x85 e", "x <|endoftext|> y<|endoftext|>", "日本語 🙂🙂 's it's", "\0a"]
    odd += ["".join(rng.choice(" \nab\t'sé1.🙂_ <|endoftext|>") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    for text in odd:
        assert np.frombuffer(pieces.ids(text), pieces.type).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids, repr(text)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(rans, "CACHE", 50)
    pieces, rng = rans.Pieces(PATH), random.Random(2)
    for _ in range(60):
        text = " ".join(str(rng.randrange(300)) for _ in range(40))
        assert np.frombuffer(pieces.ids(text), pieces.type).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids
        assert len(pieces.known.young) <= 50 and len(pieces.known.old) <= 50


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 1000, 70_000, 600_000, 1_100_000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 50_000).astype(KIND)
    cuts = np.sort(rng.integers(0, n + 1, 5))
    docs = [p.tobytes() for p in np.split(ids, cuts)]
    lengths, back = rans.decode_segment(rans.encode_segment(docs, KIND))
    assert back.tobytes() == ids.tobytes()
    assert lengths.tolist() == [len(d) // 2 for d in docs]


def test_one_id_only_and_every_id():
    for ids in (np.full(5000, 7, KIND), np.arange(50_257).astype(KIND)):
        assert rans.decode_segment(rans.encode_segment([ids.tobytes()], KIND))[1].tobytes() == ids.tobytes()


def test_checkpoints_decode_alone():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.geometric(0.01, rans.BLOCK), 50_000).astype(KIND)
    data = rans.encode_segment([ids.tobytes()], KIND)
    view, at = memoryview(data), rans._HEAD.size + 4
    (present,) = struct.unpack_from("<I", view, at)
    at += 4
    table = rans.Table(np.frombuffer(view, "<u4", present, at).astype(np.int64), np.frombuffer(view, "<u4", present, at + 4 * present))
    block = rans.BlockReader(view, at + 8 * present)
    assert block.marks == 2
    out = np.zeros(block.n, KIND)
    block.stretch(1, table, out)  # the second half, without the first
    half = rans.CHECK * block.lanes
    assert (out[half:] == ids[half:]).all() and not out[:half].any()


def test_damage_is_noticed():
    data = bytearray(rans.encode_segment([np.arange(3000).astype(KIND).tobytes()], KIND))
    data[len(data) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.decode_segment(bytes(data))


def test_scaled_frequencies():
    counts = np.array([1, 0, 10**9, 3] + [1] * 40_000)
    freq = rans.scaled(counts)
    assert freq.sum() == 1 << rans.BITS and ((freq > 0) == (counts > 0)).all()


def test_digest(random_docs, odd_docs):
    for docs in (random_docs, odd_docs):
        _check(docs, rans.encoded_digest(docs).collect())


def test_small_segments(spark, random_docs, monkeypatch):
    monkeypatch.setattr(rans, "SEGMENT", 500)
    path = scratch_path(spark, "segments")
    rans.write_tokens(random_docs, path)
    _check(random_docs, rans.read_digest(spark, path).collect())


def test_no_rows(no_docs):
    assert rans.encoded_digest(no_docs).count() == 0
