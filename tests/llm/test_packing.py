"""Packing: every id once, sequences gapless, little padding, the least squares plan itself."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfwise.llm import byte_bpe, packing

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
RNG = np.random.default_rng(4)
SHAPES = {
    "geometric": np.bincount(np.minimum(RNG.geometric(0.004, 20_000), 1023), minlength=1024),
    "even": np.bincount(RNG.integers(1, 1024, 50_000), minlength=1024),
    "large": np.bincount(RNG.integers(1, 1024, 2000), minlength=1024) * 10**9,
    "one length": np.bincount([600] * 999, minlength=1024),
    "above half": np.bincount(RNG.integers(520, 1024, 5000), minlength=1024),
    "short": np.bincount(RNG.integers(1, 30, 20_000), minlength=1024),
    "a third at one": np.bincount([300] * 10_000 + RNG.integers(1, 1024, 20_000).tolist(), minlength=1024),
    "nothing": np.zeros(1024, np.int64),
}


@pytest.mark.parametrize("name", SHAPES)
def test_plan(name):
    histogram = SHAPES[name]
    rows, sequences = packing.plan(histogram)
    ids = int((histogram * np.arange(1024)).sum())
    assert len(rows) < 20_000  # by lengths, not by documents
    assert 0 <= sequences * 1024 - ids <= 0.01 * ids + 1024 * (ids > 0)
    for n in np.flatnonzero(histogram):  # ranks of a length are dealt without gap
        mine = rows[rows[:, 0] == n]
        mine = mine[np.argsort(mine[:, 1])]
        assert mine[0, 1] == 0 and mine[-1, 2] == histogram[n] and (mine[1:, 1] == mine[:-1, 2]).all()


@pytest.mark.parametrize("window", [16, 100])
def test_places(window):
    histogram = np.bincount(RNG.integers(1, window, 700), minlength=window)
    rows, sequences = packing.plan(histogram, window, 0)
    places, used = packing.Places(rows, window), defaultdict(list)
    for n in np.flatnonzero(histogram).tolist():
        for rank in range(histogram[n]):
            pieces = places.pieces(n, rank)
            assert [p[0] for p in pieces] == [0, *np.cumsum([p[1] for p in pieces])[:-1]] and sum(p[1] for p in pieces) == n
            for _, size, sequence, offset in pieces:
                used[sequence] += range(offset, offset + size)
    assert sorted(used) == list(range(sequences))
    assert all(sorted(u) == list(range(len(u))) and len(u) <= window for u in used.values())


def test_combinations_fill_the_window():
    lengths, repeats = packing.combinations(np.arange(1, 32), 32)
    assert ((lengths * repeats).sum(1) == 32).all() and (repeats[lengths == 0] == 0).all()
    got = {tuple(sorted((n, t) for n, t in zip(a, b) if t)) for a, b in zip(lengths.tolist(), repeats.tolist())}
    assert len(got) == len(lengths)
    want = {((a, 32 // a),) for a in range(1, 32) if 32 % a == 0}
    want |= {((a, s), (b, t)) for a in range(1, 32) for b in range(a + 1, 32) for s in range(1, 33) for t in range(1, 33) if a * s + b * t == 32}
    want |= {((a, 1), (b, 1), (32 - a - b, 1)) for a in range(1, 32) for b in range(a + 1, 32) if b < 32 - a - b}
    assert got == want


def test_least_squares_meet_a_histogram_made_of_combinations():
    lengths, repeats = packing.combinations(np.arange(1, 64), 64)
    made = np.zeros(64)
    for k in RNG.choice(len(lengths), 30, replace=False):
        np.add.at(made, lengths[k], repeats[k] * 1000)
    x = packing.repeat_counts(lengths, repeats, made)
    found = np.zeros(64)
    np.add.at(found, lengths.ravel(), (repeats * x[:, None]).ravel())
    assert (x >= 0).all() and np.linalg.norm(found[1:] - made[1:]) < 0.01 * np.linalg.norm(made[1:])
    counts = packing.rounded(x, lengths, repeats, made.astype(np.int64))
    served = np.zeros(64)
    np.add.at(served, lengths.ravel(), (repeats * counts[:, None]).ravel())
    assert (served[1:] <= made[1:]).all() and served[1:].sum() > 0.9 * made[1:].sum()


def _check(docs, window=1024):
    want = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id].append(TOKENIZER.encode(r.text or "", add_special_tokens=False).ids + [0])
    rows = packing.pack(docs, window=window).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
    assert set(pieces) == set(want)
    for doc_id, texts in want.items():
        spans = lambda ids: {(a, bytes(struct.pack(f"<{b}I", *ids[a : a + b])), len(ids)) for a, b in cuts if a + b <= len(ids)}
        cuts = {(p.start, p.length) for p in pieces[doc_id]}
        assert sum(p.length for p in pieces[doc_id]) == sum(map(len, texts))
        allowed = set().union(*(spans(ids) for ids in texts))
        assert all((p.start, bytes(p.ids), p.doc_tokens) in allowed for p in pieces[doc_id])
        if len(texts) == 1:
            at = 0
            for p in sorted(pieces[doc_id], key=lambda p: p.start):
                assert p.start == at
                at += p.length
            assert at == len(texts[0])
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
    total = sum(len(ids) for texts in want.values() for ids in texts)
    assert len(sequences) * window - total < 0.02 * total + 2 * window


def test_pieces(odd_docs, random_docs, no_docs):
    _check(odd_docs)
    _check(random_docs)
    _check(random_docs, window=64)
    assert packing.pack(no_docs).count() == 0


def test_one_length_holds_a_third(make_docs):
    _check(make_docs([(k, " one two three" if k % 3 else " word" * (k % 90), "en", "a") for k in range(400)]), window=32)


def test_ids_are_the_library_s():
    """Every code point in every position of a pre-token, special strings, long runs."""
    coder, points = byte_bpe.encoder("byte_bpe_50k.json"), [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [(lambda c: f"a{c}b1{c}2 {c}.{c}, {c}{c} '{c}s  {c}")(chr(c)) for c in points]
    texts += ["", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|", "z" * 300_000, " " * 100_000, "\n\n \n" * 50_000, "é" * 50_000, "1" * 50_000]
    for k in range(0, len(texts), 20_000):
        part = texts[k : k + 20_000]
        for text, one in zip(part, TOKENIZER.encode_batch_fast(part, add_special_tokens=False)):
            assert np.frombuffer(coder.ids(text), coder.type).tolist() == one.ids, repr(text[:40])


def test_a_difference_stops_the_job(monkeypatch):
    coder = byte_bpe.RankEncoder("byte_bpe_50k.json")
    monkeypatch.setattr(byte_bpe, "AUDIT", 1)
    coder.ids("as it is")
    coder.merges = byte_bpe.RankEncoder("byte_bpe_50k.json").merges.__class__("other", pat_str=r"\S|\s", mergeable_ranks=coder.merges._mergeable_ranks, special_tokens=coder.special)
    with pytest.raises(ValueError):
        coder.ids("as it is not")
