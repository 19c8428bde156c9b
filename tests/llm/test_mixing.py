"""Targets against the iterative definition; the mix against its targets."""

from collections import defaultdict

import pytest

from shelfwise.llm import mixing

SEPARATORS = " \t\n\x0b\x0c\r"


def _size(text):
    for c in SEPARATORS:
        text = (text or "").replace(c, " ")
    return len([w for w in text.split(" ") if w])


def _targets(sizes, weights=(5, 2, 1), most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else share[s] for s in names}
        full |= above


def _check(docs, report):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += _size(r.text)
    want = _targets(sizes) if sizes else {}
    by = defaultdict(list)
    for r in report:
        by[r.source_size, round(r.target, 6)].append(r)
        assert 0 <= r.taken <= 3 * r.size
    expected = sorted((sizes[s], round(want[s], 6)) for s in sizes)
    assert sorted({(r.source_size, round(r.target, 6)) for r in report}) == sorted(set(expected))
    assert len(report) == len(rows)
    for (size, target), got in by.items():
        sources = expected.count((size, target))
        assert abs(sum(r.taken for r in got) - sources * target) <= sources, (size, target)


def test_random(random_docs):
    _check(random_docs, mixing.mix_report(random_docs).collect())


def test_odd(odd_docs):
    _check(odd_docs, mixing.mix_report(odd_docs).collect())


def test_tree_of_many_leaves(random_docs, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 5)
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    _check(random_docs, mixing.mix_report(random_docs).collect())


def test_repeated_rows_are_one_hot_document(make_docs):
    docs = make_docs([(1, "a b c", "en", "hot")] * 300 + [(k, "x " * (k % 9 + 1), "en", f"s{k % 4}") for k in range(2, 200)])
    _check(docs, mixing.mix_report(docs).collect())


def test_reruns_agree_on_any_layout(random_docs):
    one = sorted(map(tuple, mixing.mix_report(random_docs).collect()))
    other = sorted(map(tuple, mixing.mix_report(random_docs.repartition(7, "text")).collect()))
    assert one == other


def test_mixed_rows_match_the_report(random_docs):
    report = {r.doc_id: r for r in mixing.mix_report(random_docs).collect()}
    mixed = mixing.mix(random_docs)
    assert mixed.columns == random_docs.columns
    words = defaultdict(int)
    for r in mixed.select("doc_id", "text").collect():
        words[r.doc_id] += _size(r.text)
    assert {d: r.taken for d, r in report.items() if r.taken} == dict(words)


@pytest.mark.parametrize("fixture", ["no_docs"])
def test_no_rows(request, fixture):
    docs = request.getfixturevalue(fixture)
    assert mixing.mix_report(docs).count() == 0
    assert mixing.mix(docs).count() == 0
