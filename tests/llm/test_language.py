"""Code lengths against a plain context tree; held-out predictions."""

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import language as ln
from shelfwise.llm.common import text_slices

from conftest import SF001


def _symbols():
    own = np.full(256, ln.ALPHABET - 1, np.int32)
    for k, b in enumerate(b" etaoinshrdlucmfwypvbgkjqxz.,0\xc3\xa9"):
        own[b] = k
    return own[ln._FOLD]


def _symbol_runs(text, symbols):
    return [int(symbols[32])] * ln.ORDER + [int(symbols[b]) for b in text.encode()]


def _plain_bits(training, text, symbols):
    """Code length of a text, symbol by symbol, from counts kept in dictionaries."""
    counts = [defaultdict(lambda: defaultdict(int)) for _ in range(ln.ORDER + 1)]
    for t in training:
        run = _symbol_runs(t, symbols)
        for i in range(ln.ORDER, len(run)):
            for order in range(ln.ORDER + 1):
                counts[order][tuple(run[i - order : i])][run[i]] += 1
    total, run = 0.0, _symbol_runs(text, symbols)
    for i in range(ln.ORDER, len(run)):
        for order in range(ln.ORDER, -2, -1):
            if order < 0:
                total += math.log2(ln.ALPHABET)
                break
            seen = counts[order].get(tuple(run[i - order : i]))
            if not seen:
                continue
            n, kinds = sum(seen.values()), len(seen)
            if run[i] in seen:
                total -= math.log2(seen[run[i]] / (n + kinds))
                break
            total -= math.log2(kinds / (n + kinds))
    return total


def test_table_gives_the_tree_s_code_lengths():
    symbols = _symbols()
    training = ["the cat sat on the mat", "The hat, été 42", "", "on and on"]
    seen = defaultdict(int)
    for part in text_slices(pa.array(training)):
        for s in ln.strings(part, symbols)[0]:
            seen[int(s)] += 1
    keys = np.array(sorted(seen))
    table = ln.code_lengths(keys, np.array([seen[k] for k in keys]))
    for text in ("the mat", "zebra é 7", "THE", "\n\n", "日本"):
        number, _ = ln.strings(next(text_slices(pa.array([text]))), symbols)
        assert table[number].astype(float).sum() == pytest.approx(_plain_bits(training, text, symbols), rel=1e-4)


def test_texts_of_a_slice_do_not_touch():
    symbols = _symbols()
    texts = ["abc", "", "x", "defgh"]
    together = np.concatenate([ln.strings(p, symbols)[0] for p in text_slices(pa.array(texts))])
    alone = np.concatenate([ln.strings(p, symbols)[0] for t in texts for p in text_slices(pa.array([t]))])
    assert (together == alone).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = ln.held_out_identification(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert len(out) > 20 and sum(r.lang == r.lang_pred for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_odd(odd_docs):
    got = ln.held_out_identification(odd_docs).collect()
    assert len(got) == odd_docs.count()
    texts = {r.doc_id: r.lang_pred for r in got}
    assert texts[1] == texts[2] == texts[3] == "und"
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = ln.keep_identified(odd_docs, ln.fit(odd_docs))
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} >= {5, 9}
    assert not {r.doc_id for r in kept.collect()} & {1, 2, 3}


def test_more_languages_than_a_block(random_docs, monkeypatch):
    docs = random_docs.selectExpr("doc_id", "text", "concat('l', doc_id % 5) as lang")
    model = ln.fit(docs)
    one = sorted(map(tuple, ln.identify(docs, model).collect()))
    monkeypatch.setattr(ln, "BLOCK", 2)
    assert sorted(map(tuple, ln.identify(docs, model).collect())) == one


def test_nothing_to_learn(odd_docs, no_docs):
    unlabelled = odd_docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in ln.held_out_identification(unlabelled).collect()} == {"und"}
    assert ln.held_out_identification(no_docs).count() == 0
