"""Benchmark windows against a brute-force scan."""

import hashlib
import random
import re

import pytest

from shelfwise.llm import decontaminate as dc

BENCH = "item_id long, text string, n_words int"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text):
    return _WORD.findall((text or "").translate(_LOWER))


def _brute(text, items, n=10):
    words, hit, found = _words(text), set(), set()
    for item, body in items:
        run = _words(body)
        size = min(n, len(run))
        for k in range(len(run) - size + 1) if size else ():
            for at in range(len(words) - size + 1):
                if words[at : at + size] == run[k : k + size]:
                    hit |= set(range(at, at + size))
                    if item is not None:
                        found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def _items():
    rng = random.Random(3)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "délta"]) for _ in range(30))
    return [(1, long), (2, long.upper() + " more"), (3, "two words"), (4, None), (5, ""), (None, "lone item here"), (7, long), (7, "x y")]


def _docs(make_docs):
    rng = random.Random(4)
    long = _items()[0][1]
    texts = [
        long, "see " + long.replace(" ", ",\n") + " there", " ".join(long.split()[5:14]), " ".join(long.split()[5:15]), "TWO-words", "the lone item here, x  y",
        "x y", " ".join(rng.choice(["alpha", "beta", "gamma", "délta"]) for _ in range(400)), long + " " + long, None, "", "no match",
    ]
    return make_docs([(k % 9, t, "en", "s") for k, t in enumerate(texts)])


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 200])
def test_against_brute_force(spark, make_docs, odd_docs, block):
    docs = _docs(make_docs).unionByName(odd_docs)
    items = _items()
    got = dc.contamination(docs, spark.createDataFrame([(*i, 0) for i in items], BENCH), block_bytes=block).collect()
    want = [(r.doc_id, *_brute(r.text, items)) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_long_items_are_cut_without_loss(spark, make_docs, monkeypatch):
    monkeypatch.setattr(dc, "PIECE_WORDS", 7)
    items = _items()
    docs = _docs(make_docs)
    pieces = [p for b in dc._pieces(spark.createDataFrame([(str(i), t) for i, t in items], "i string, t string").toArrow().to_batches(), 10) for p in b.to_pylist()]
    held = dc.WindowSet([(p["item"], p["words"]) for p in pieces], 10)
    whole = dc.WindowSet([(str(i), b" ".join(dc.normal_words(t))) for i, t in items if dc.normal_words(t)], 10)
    assert {k: set(v[0].tolist()) for k, v in held.by_size.items()} == {k: set(v[0].tolist()) for k, v in whole.by_size.items()}
    assert docs.count() == 12


def test_remove_documents_and_spans(spark, make_docs):
    items = spark.createDataFrame([(1, "one two three", 0)], BENCH)
    docs = make_docs([(1, "zero One, two; three. four", "en", "s"), (2, "one two four", "en", "s"), (3, None, None, None)])
    assert sorted(r.doc_id for r in dc.drop_contaminated(docs, items).collect()) == [2, 3]
    cut = dc.remove_spans(docs, items)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "zero . four", 2: "one two four", 3: None}


def test_empty_tables(spark, no_docs, odd_docs):
    items = spark.createDataFrame([], BENCH)
    assert dc.contamination(no_docs, items).count() == 0
    assert not any(r.contaminated for r in dc.contamination(odd_docs, items).collect())
    assert dc.drop_contaminated(odd_docs, items).count() == odd_docs.count()


def test_items_digest():
    assert dc.items_digest([10, 9, 100]) == hashlib.sha256(b"10,100,9").hexdigest()
