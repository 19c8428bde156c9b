import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use themselves.
CLASH = (
    "size int, score string, shard string, part int, place int, row string, hashes string, copies int, n_words string, component string, "
    "_bits string, _letters int, _lang_pred int, _lang_score string, _set string, _size string, _k int, _first string, _first_set string, _hits string, _n_words string, _items int, "
    "_id string, _hash string, _source int, _k_id string, _k_source int, _k_hash string, _k_size string, _copies string, _part string, _nth string, _run string, _row string, _doc string, "
    "n string, form int, output int, rest string, ids string, h0 string, c0 string, c1 int, set string, least string, times string, h2 string"
)


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows, with columns of clashing names."""

    def make(rows):
        full = [(*r, None if r[1] is None else len(r[1]), *([None] * len(CLASH.split(',')))) for r in rows]
        return spark.createDataFrame(full, f"{DOCS}, {CLASH}")

    return make


@pytest.fixture
def odd_docs(make_docs):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    rng = random.Random(5)
    words = ["lorem", "ipsum", "Dolor", "sit", "amet,", "été", "straße", "x1", "—", "end."]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    same = " ".join(rng.choice(words) for _ in range(60))
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", "a"),
        (3, " \n\t ", None, None),
        (None, same, "fr", "b"),
        (4, same, None, "b"),
        (4, same, None, "b"),
        (4, same + " tail", "fr", None),
        (5, long, "en", "b"),
        (6, "z" * 300_000, "en", "a"),
        (7, "one", "en", "a"),
        (8, "one two", "en", "a"),
        (9, "日本語 テキスト 🙂", "ja", "c"),
        (None, None, None, None),
    ]
    return make_docs(rows)


@pytest.fixture
def no_docs(make_docs):
    return make_docs([])


@pytest.fixture
def random_docs(make_docs):
    """A few hundred documents with copies, near copies and shared passages."""
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randint(3, 120))] for _ in range(120)]
    passage = [rng.choice(words) for _ in range(40)]
    texts = []
    for b in base:
        texts.append(b)
        for _ in range(rng.choice([0, 0, 1, 3])):
            c = list(b)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append(c)
        if rng.random() < 0.3:
            texts.append(b[: len(b) // 2] + passage + b[len(b) // 2 :])
    rng.shuffle(texts)
    return make_docs([(k, " ".join(t).upper() if k % 7 == 0 else " ".join(t), "en", f"s{k % 5}" if k % 3 else "hot") for k, t in enumerate(texts)])
