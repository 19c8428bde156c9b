"""Components and set sizes against all pairs."""

import random
import re

import numpy as np
import pytest

from shelfwise.llm import jaccard

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 3]) for k in range(len(words) - 2)}


def _brute(rows, percent=90):
    sets = [_set(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(k):
        while part[k] != k:
            k = part[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                part[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[root(k)] = min(least.get(root(k), d), d)
    return sorted(((d, len(sets[k]), least.get(root(k))) for k, (d, _) in enumerate(rows)), key=repr)


def _got(docs, **options):
    return sorted((tuple(r) for r in jaccard.join_components(docs, **options).collect()), key=repr)


def _rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


def test_random(random_docs):
    assert _got(random_docs) == _brute(_rows(random_docs))


@pytest.mark.parametrize("percent", [50, 80])
def test_other_thresholds(random_docs, percent):
    assert _got(random_docs, percent=percent) == _brute(_rows(random_docs), percent)


def test_odd(odd_docs):
    assert _got(odd_docs) == _brute(_rows(odd_docs))


def test_chains_and_a_large_group(make_docs):
    rng = random.Random(9)
    words = [f"t{k}" for k in range(300)]
    base = [rng.choice(words) for _ in range(150)]
    rows = []
    for k in range(150):  # near copies, many of them not linked to each other
        text = list(base)
        for _ in range(rng.randint(0, 5)):
            text[rng.randrange(150)] = rng.choice(words)
        rows.append((k, " ".join(text), "en", "s"))
    chain = list(base[:100])
    for k in range(40):  # each linked to the next only
        chain[2 * k % 100] = f"c{k}"
        rows.append((1000 + k, " ".join(chain), "en", "s"))
    docs = make_docs(rows)
    assert _got(docs) == _brute(_rows(docs))


def test_segments_of_linked_sets_meet():
    rng = np.random.default_rng(1)
    classes = jaccard.Classes()
    for n in (10, 11, 19, 20, 37, 60, 133, 400, 1500):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            drop = rng.integers(0, len(a) // 10 + 1)
            b = np.unique(np.concatenate([a[drop:], rng.integers(0, 1 << 63, rng.integers(0, 2 + len(a) // 20), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both) and len(a) + len(b) > 2 * both:
                assert len(np.intersect1d(jaccard.segment_keys(a, classes), jaccard.segment_keys(b, classes)))


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(5)
    for n in (10, 25, 63, 64, 200, 900):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
            keep = rng.random(len(a)) > rng.choice([0.02, 0.05, 0.1, 0.3])
            b = np.unique(np.concatenate([a[keep], rng.integers(0, 1 << 64, rng.integers(0, 1 + n // 10), dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            x, y = (np.frombuffer(jaccard.sketch(s), np.uint8)[None, :] for s in (a, b))
            allowed = jaccard.may_link(len(a), x, np.array([len(b)]), y, 90)[0]
            if 100 * both >= 90 * (len(a) + len(b) - both):
                assert allowed
            fewer = min(x.shape[1], y.shape[1]) // 2
            unequal = (jaccard.folded(x, fewer) != jaccard.folded(y, fewer)).sum()
            assert unequal <= len(a) + len(b) - 2 * both


def test_large_buckets_are_cut_into_blocks(random_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 2)
    monkeypatch.setattr(jaccard, "ROUNDS", 0)
    assert _got(random_docs, percent=60) == _brute(_rows(random_docs), 60)


def test_keep_one(random_docs, odd_docs):
    for docs in (random_docs, odd_docs):
        kept = jaccard.keep_one(docs)
        assert kept.columns == docs.columns
        want = _brute(_rows(docs))
        groups = {(c, n == 0) for _, n, c in want if n} | set()
        got = kept.select("doc_id", "text").collect()
        assert len([r for r in got if _set(r.text)]) == len(groups)
        assert len([r for r in got if not _set(r.text)]) == len([w for w in want if not w[1]])




def test_star_contraction(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(200, 200 + k) for k in range(1, 30)] + [(rng.randrange(300, 330), rng.randrange(300, 330)) for _ in range(25)]
    part = {}
    for u, v in edges:
        a, b = part.setdefault(u, {u}), part.setdefault(v, {v})
        if a is not b:
            a |= b
            for x in b:
                part[x] = a
    got = {r.node: r.component for r in jaccard.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: min(s) for k, s in part.items() if len(s) > 1}


def test_no_rows(no_docs):
    assert jaccard.join_components(no_docs).count() == 0
    assert jaccard.keep_one(no_docs).count() == 0
