"""Languages of several scripts, rare ones beside large ones."""

import random

import numpy as np
import pytest

from shelfwise.llm import language as ln

LETTERS = {
    "en": ("abcdefghijklmnopqrstuvwxyz", 400),
    "ru": ("".join(map(chr, range(0x430, 0x450))), 400),
    "hy": ("".join(map(chr, range(0x561, 0x587))), 12),
    "ka": ("".join(map(chr, range(0x10D0, 0x10F1))), 12),
    "th": ("".join(map(chr, range(0xE01, 0xE2F))), 12),
    "zh": ("".join(map(chr, range(0x4E00, 0x5200))), 40),
}


def test_rare_scripts_are_told_apart(spark):
    rng = random.Random(4)
    rows = []
    for lang, (letters, n) in LETTERS.items():
        rows += [(" ".join("".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(8)), lang) for _ in range(n)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    got = ln.identify(docs, ln.fit(docs)).collect()
    wrong = [(r.lang, r.lang_pred) for r in got if r.lang != r.lang_pred]
    assert not wrong


def test_every_byte_has_a_length():
    counts = np.zeros(256, np.int64)
    counts[np.unique(ln._FOLD)[:120]] = np.arange(1, 121)
    symbols, bits = ln.alphabet(counts)
    folded = np.unique(ln._FOLD)
    rare = folded[symbols[folded] == ln.ALPHABET - 1]
    assert len(rare) == len(folded) - (ln.ALPHABET - 1)
    assert (bits[rare] > 0).all() and (2.0 ** -bits[rare].astype(float)).sum() <= 1 + 1e-5
    assert not bits[folded[symbols[folded] < ln.ALPHABET - 1]].any()


@pytest.mark.parametrize("seen", [[], [32], [32, 97]])
def test_few_bytes(seen):
    counts = np.zeros(256, np.int64)
    counts[seen] = 5
    symbols, bits = ln.alphabet(counts)
    assert symbols[32] == 0 and np.isfinite(bits).all()


def test_copies_neither_fill_nor_empty_the_sample(spark):
    rows = [(f"few {k % 2}", f"l{j}") for j in range(6) for k in range(300)]  # two texts, 300 rows each
    rows += [(f"own text {k}", "many") for k in range(200)] + [("the copied one", "many")] * 200
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = ln.fit(docs, sample=20)
    assert model.languages == [*(f"l{j}" for j in range(6)), "many"]
    again = ln.fit(docs.dropDuplicates().repartition(3), sample=20)
    for one, other in zip(model.parts, again.parts, strict=True):
        assert all((a == b).all() for a, b in zip(one, other, strict=True))


def test_tables_of_many_languages_are_laid_out_by_blocks(spark, monkeypatch):
    rng = random.Random(8)
    own = {f"l{k:02}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for k in range(70)}
    rows = [(" ".join(rng.choices(words, k=20)), lang) for lang, words in own.items() for _ in range(3)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = ln.fit(docs)
    sizes = []
    laid_out = ln.Model.laid_out
    monkeypatch.setattr(ln, "BLOCK", 16)
    monkeypatch.setattr(ln.Model, "laid_out", lambda self, languages: sizes.append(len(languages)) or laid_out(self, languages))
    got = ln.identify(docs, model).collect()
    assert sizes == [16, 16, 16, 16, 6]
    assert all(r.lang == r.lang_pred for r in got) and len(got) == len(rows)
