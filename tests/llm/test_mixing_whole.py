"""The pipeline's mix: whole documents, near the targets."""

from collections import Counter

import corpus_pipeline
from shelfwise.llm import mixing


def test_stage_takes_whole_documents(spark, make_docs):
    docs = make_docs([(k, f"text  {k}\twith " + "words " * (3 + k % 40), "en", f"host{k % 60}") for k in range(150)])
    rows = {r.doc_id: r for r in docs.collect()}
    got = corpus_pipeline.mix_sources(spark, docs, "").collect()
    assert all(r == rows[r.doc_id] for r in got)
    taken, cut = Counter(r.doc_id for r in got), 0
    for r in mixing.mix_report(docs).collect():
        assert taken[r.doc_id] - r.copies in ((0, 1) if r.part else (0,))
        cut += r.part > 0
    assert cut
    assert sorted(got, key=repr) == sorted(corpus_pipeline.mix_sources(spark, docs.repartition(5), "").collect(), key=repr)


def test_residuals_meet_across_sources(spark, make_docs):
    """Hundreds of sources of one long document each: the corpus keeps its size to one document."""
    docs = make_docs([(k, "word " * 1000, "en", f"host{k:03}") for k in range(300)])
    got = Counter(r.doc_id for r in mixing.mix(docs, whole=True).select("doc_id").collect())
    assert abs(sum(got.values()) - 300) <= 1
    assert max(got.values()) <= 3 and len(set(got.values())) > 1


def test_a_row_repeated_many_times(spark, make_docs, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 7)
    docs = make_docs([(1, "one two", "en", "a")] * 400 + [(2, "three four five", "en", "b")] * 30 + [(k, "six", "en", "b") for k in range(3, 9)])
    taken = Counter()
    for r in mixing.mix_report(docs).collect():
        taken[r.doc_id] += r.copies + (r.part > 0)
    got = Counter(r.doc_id for r in mixing.mix(docs).select("doc_id").collect())
    assert mixing.mix_report(docs).count() == 436 and got == +taken
