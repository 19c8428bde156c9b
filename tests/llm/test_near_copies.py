"""Near copies by shingles of other sizes against all pairs."""

import random
import re

import pytest

from shelfwise.llm import jaccard

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _components(rows, size, percent):
    """(id, component) of every row, empty texts on their own."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER))
        sets.append({tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set())
    part = list(range(len(rows)))

    def root(k):
        while part[k] != k:
            k = part[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                part[root(i)] = root(j)
    least = {}
    for k, (d, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), d), d)
    return sorted((d, least[root(k)]) for k, (d, _) in enumerate(rows))


def test_a_changed_word_in_fifty(make_docs):
    rng = random.Random(3)
    rows = []
    for n in (10, 45, 49, 50, 55, 59, 70):
        base = [f"w{n}x{k}" for k in range(n)]
        other = list(base)
        other[n // 2] = f"changed{n}"
        rows += [(10 * n, " ".join(base), "en", "s"), (10 * n + 1, " ".join(other), "en", "s")]
    rows += [(5, "one two three four", "en", "s"), (6, "one two three four", "en", "s"), (7, "one two three five", "en", "s")]
    rng.shuffle(rows)
    kept = jaccard.keep_one(make_docs(rows), shingle=5, percent=80)
    got = sorted(r.doc_id for r in kept.collect())
    assert got == [d for d, c in _components([r[:2] for r in rows], 5, 80) if d == c]
    assert 500 in got and 501 not in got


@pytest.mark.parametrize("size, percent", [(5, 80), (1, 70)])
def test_components_of_other_shingles(random_docs, size, percent):
    rows = [tuple(r) for r in random_docs.select("doc_id", "text").collect()]
    got = jaccard.join_components(random_docs, shingle=size, percent=percent)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == _components(rows, size, percent)
