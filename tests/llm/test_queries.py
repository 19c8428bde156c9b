"""The registered queries, their oracle SQL and the pipeline."""

import importlib
import math
import re
import struct
import sys
import zlib
from collections import Counter

import duckdb
import pytest
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from shelfwise.llm import queries
from shelfwise.llm.decontaminate import normal_words

from conftest import SF001
from .test_mixing import _size as _words
from .test_mixing import _targets
from .test_near_copies import _components

COLUMNS = {
    "op1": {"page_id", "url", "text", "n_chars"},
    "op2": {"query_id", "rank", "vec_id", "score"},
    "op3": {"doc_id", "held_out", "lang_pred", "score"},
    "op4": {"doc_id", "held_out", "score", "predicted"},
    "op5": {"doc_id", "n_bytes", "n_tokens", "over_limit"},
    "op6": {"doc_id", "size", "source_size", "target", "taken"},
    "op7": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op8": {"doc_id", "n_shingles", "component_id"},
    "op9": {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"},
    "op10": {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"},
    "op11": {"doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"},
    "op12": {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
    "op13": {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"},
}
TYPES = {"score": "double", "target": "double", "rank": "int", "predicted": "int", "shard": "int", "grown_shard": "int"}


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted({n.split("_")[0] for n in names}) == sorted(COLUMNS) and len(names) == 13
    assert "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_schema(spark, name):
    got = queries.QUERIES[name](spark, SF001)
    kinds = dict(got.dtypes)
    assert COLUMNS[name.split("_")[0]] <= set(kinds)
    for column, kind in kinds.items():
        if column in TYPES:
            assert kind == TYPES[column], column
        elif column in ("doc_id", "vec_id", "query_id", "page_id", "size", "taken", "source_size", "start", "slot", "text_crc32", "component_id", "n", "length", "offset", "depth", "conv_id", "saved_tokens", "doc_tokens", "sequence_id") or column.startswith(("n_", "ids_")):
            assert kind == "bigint", column


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{SF001}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF001)
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(want.fetchall())


def test_entry_without_the_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        importlib.reload(entry)
        assert "pipeline" not in entry.queries() and not any(n.startswith("op") for n in entry.oracle_sql())
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
    assert "pipeline" in entry.queries()


def _check_mix(before, after):
    """Whole rows, each 0 to 3 times, every source within a document of its target and the corpus within one of its size."""
    sizes, of = Counter(), {r.doc_id: r for r in before}
    for r in before:
        sizes[r.source] += _words(r.text)
    want, taken, times = _targets(sizes), Counter(), Counter(r.doc_id for r in after)
    for r in after:
        assert r == of[r.doc_id]
        taken[r.source] += _words(r.text)
    for doc_id, n in times.items():
        r = of[doc_id]
        assert math.floor(want[r.source] / sizes[r.source]) <= n <= math.ceil(want[r.source] / sizes[r.source] - 1e-9)
    longest = max(map(_words, (r.text for r in before)))
    assert all(abs(taken[s] - want[s]) <= longest for s in sizes)
    assert abs(sum(taken.values()) - sum(want.values())) <= longest + len(sizes)


def test_pipeline_stages(spark, tmp_path):
    """Each stage against brute force on the documents its predecessor kept."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF001)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / str(k)))
        before, docs = docs, spark.read.parquet(str(tmp_path / str(k)))
        rows[k] = ([r for r in before.collect()], [r for r in docs.collect()])
    before, after = rows[0]
    assert len(before) == 200 and {r.doc_id for r in before} - {r.doc_id for r in after} <= {r.doc_id for r in before if not re.search(r"[^\W\d_]", r.text or "")}
    before, after = rows[1]
    least = dict(_components([(r.doc_id, r.text) for r in before], 3, 90))
    assert sorted(r.doc_id for r in after) == sorted(d for d, c in least.items() if d == c)
    before, after = rows[2]
    items = [normal_words(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    windows = {b" ".join(w[k : k + min(10, len(w))]) for w in items for k in range(max(1, len(w) - 9)) if w}
    sizes = {w.count(b" ") + 1 for w in windows}

    def leaks(text):
        words = normal_words(text)
        return any(b" ".join(words[k : k + n]) in windows for n in sizes for k in range(len(words) - n + 1))

    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if not leaks(r.text))
    before, after = rows[3]
    _check_mix(before, after)
    before, after = rows[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def digest(text):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        return len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))

    assert Counter((r.doc_id, *digest(r.text)) for r in before) == Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in after)
