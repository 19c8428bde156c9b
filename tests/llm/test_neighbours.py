"""Nearest neighbours against brute force."""

import math

import numpy as np

from shelfwise.llm import neighbours as nb

from conftest import SF001

TABLE = "vec_id long, embedding array<float>, label int, rank int, row long"


def _brute(rows, every, k):
    ok = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, v in ok:
        if q % every == 0:
            near = [(float((u * v).sum() / (np.sqrt((u * u).sum()) * np.sqrt((v * v).sum()))), i) for i, u in ok if i != q and len(u) == len(v)]
            out.setdefault(q, []).append(sorted(near, key=lambda x: (-x[0], x[1]))[:k])
    return out


def _recall(rows, got, every=50, k=5):
    want = _brute(rows, every, k)
    found = total = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    for q, lists in want.items():
        best = lists[0]
        mine = sorted(by.get(q, []), key=lambda r: r.rank)
        assert len(mine) == len(best) * len(lists)
        total += len(best)
        found += sum(r.score >= best[-1][0] - 1e-12 for r in mine) if best else 0
        if len(lists) == 1:
            assert [r.rank for r in mine] == list(range(1, len(best) + 1))
            assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
    return found / max(1, total)


def test_recall(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    got = nb.nearest(table).collect()
    assert _recall(rows, got) >= 0.9
    exact = {(q, i): s for q, lists in _brute(rows, 50, len(rows)).items() for s, i in lists[0]}
    assert all(abs(r.score - exact[r.query_id, r.vec_id]) < 1e-12 for r in got)


def test_several_blocks(spark):
    table = spark.read.parquet(f"{SF001}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert _recall(rows, nb.nearest(table, every=10, block=100, queries=7).collect(), every=10) >= 0.9


def test_clustered_vectors_need_few_verifications(monkeypatch):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    data = np.concatenate([c + 0.05 * rng.normal(size=(50, 16)) for c in centres])
    monkeypatch.setattr(nb, "LEAST", 20)
    index = nb.SortedProjections(data, np.arange(len(data)))
    seen = []
    verify = index._verify
    monkeypatch.setattr(index, "_verify", lambda found, *a: (seen.append(len(found)), verify(found, *a))[1])
    hits = 0
    for q, found in zip(range(0, 2000, 20), index.search(data[::20], np.arange(0, 2000, 20), 5), strict=True):
        unit = data / np.linalg.norm(data, axis=1, keepdims=True)
        score = unit @ unit[q]
        score[q] = -2
        hits += len({i for i, _ in found} & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.95 * 500 and np.median(seen) < 200


def test_odd(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (0, v), (1, v), (2, v), (3, [2.0, 4.0, 6.0]), (4, [0.0, 0.0, 0.0]), (5, None), (6, []), (7, [1.0, None, 2.0]), (8, [float("nan"), 1.0, 2.0]),
        (9, [float("inf"), 1.0, 1.0]), (None, v), (50, [-1.0, -2.0, -3.0]), (100, [1.0, 1.0]), (150, [0.0, 0.0, 0.0]), (11, [3.0, 2.0, 1.0]), (1, [9.0, 0.0, 0.0]),
    ]
    got = nb.nearest(spark.createDataFrame([(*r, 0, 1, 2) for r in rows], TABLE)).collect()
    assert _recall(rows, got) == 1.0
    assert {r.query_id for r in got} == {0, 50}
    assert [r.vec_id for r in sorted(got, key=lambda r: (r.query_id, r.rank)) if r.query_id == 0][:3] == [1, 2, 3]


def test_one_vector_holds_most_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(300)] + [(k, rng.normal(size=4).tolist()) for k in range(300, 500)]
    got = nb.nearest(spark.createDataFrame([(*r, 0, 1, 2) for r in rows], TABLE), block=64).collect()
    rows = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    assert _recall(rows, got) >= 0.95
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 100] == [0, 1, 2, 3, 4]


def test_no_rows(spark):
    assert nb.nearest(spark.createDataFrame([], TABLE)).count() == 0
