"""Prefix token counts against the library."""

import random

import sentencepiece

from shelfwise.llm import token_counts as tc

PATH = tc.vocabulary_path()
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
COUNTS = tc.PrefixCounts(PATH)


def _texts(n=400, seed=1):
    rng = random.Random(seed)
    fixed = ["", " ", "   ", "\n", " \n a", "a ", " a  b\n\n\nc\t", "▁x ▁▁ y", "<s> </s> <unk>", "日本語テキスト 🙂🙂", "a" * 700, "\0a\nb"]
    return fixed + ["".join(rng.choice(" \nab▁éeth1.🙂<s>") for _ in range(rng.randint(1, 60))) for _ in range(n)]


def test_every_text():
    for t in _texts():
        assert COUNTS.count(t) == len(MODEL.encode(t)), repr(t)


def test_every_prefix_of_a_run():
    for word in ("▁internationalisation", "▁▁▁été", "▁🙂straße", "▁" + "ab" * 40, "\nnew"):
        table = COUNTS.table(word)
        for k in range(len(word) + 1):
            assert table[k] == len(COUNTS.merge(word[:k])) + sum(len(p.encode()) - 1 for p in COUNTS.merge(word[:k]) if p not in COUNTS.score)


def test_cut_is_the_longest_prefix_in_budget():
    for t in _texts(120, seed=2):
        for budget in (1, 3, 10):
            fits = [k for k in range(len(t) + 1) if len(MODEL.encode(t[:k])) <= budget]
            assert COUNTS.cut(t, budget) == fits[-1]


def test_query_columns(odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    got = tc.token_counts(odd_docs, budget=50).collect()
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), len(MODEL.encode(r.text or ""))) for r in rows)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 50) for r in got)


def test_no_rows(no_docs):
    assert tc.token_counts(no_docs).count() == 0
