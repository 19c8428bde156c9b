"""Fill-in-middle against a plain loop over the units."""

import hashlib
import re

from pyspark.sql import functions as F

from shelfwise.llm import fill_middle

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _want(doc_id, text, rate=50, spm=80, seed=42):
    text = text or ""
    units, digest = UNITS.findall(text), _sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, _sha(text), _sha(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < spm else "psm"
    made = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), _sha(made), _sha(text)


def _check(docs, **options):
    rows = docs.select("doc_id", "text").collect()
    got = sorted(map(tuple, fill_middle.fill_in_middle_digest(docs, **options).collect()), key=str)
    assert got == sorted((_want(*r, **options) for r in rows), key=str)
    return got


def test_odd_and_random_documents(odd_docs, random_docs, no_docs):
    _check(odd_docs)
    _check(odd_docs, rate=100)
    assert {r[2] for r in _check(random_docs)} == {"plain", "spm", "psm"}
    assert {r[2] for r in _check(random_docs, rate=100, spm=0, seed=7)} == {"psm"}
    _check(no_docs)


def test_texts_that_look_like_marks(make_docs):
    texts = ["a <P> b", "<S>", "x<M", "<", "<P x S> <", "a<< P>", "$1 \\1 {2}+ (?s)", " <", "\x85a b  c", "\r\n\t\x0b\x0c z ", "\0 \0"]
    docs = make_docs([(k * 100 + j, t, "en", "a") for k, t in enumerate(texts) for j in range(6)])
    _check(docs, rate=100, spm=50)


def test_long_texts_are_counted_in_place(spark, make_docs, monkeypatch):
    monkeypatch.setattr(fill_middle, "LONG", 5)
    _check(make_docs([(k, " ab\n" * k + "é" * (k % 3), "en", "a") for k in range(40)]), rate=100)
    long = make_docs([(k, "word  " * 200_000, "en", "a") for k in range(3)])
    assert {r[1] for r in _check(long, rate=100)} == {200_001}


def test_one_scan_and_one_match(random_docs):
    plan = fill_middle.fill_in_middle(random_docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?s)\\A(") == 1 and "Python" not in plan
    made = fill_middle.fill_in_middle(random_docs)
    assert made.where(fill_middle.restore(F.col("output"), F.col("form")).isNull()).count() == 0
