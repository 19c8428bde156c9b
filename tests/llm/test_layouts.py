"""Results that must not depend on how a table is laid out, and vectors of extreme size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import neighbours, quality
from shelfwise.session import session_conf

from conftest import SF001


def test_quality_of_any_layout(spark):
    docs, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    docs = docs.unionByName(docs.where("doc_id % 9 = 0").withColumn("text", F.reverse("text"))).unionByName(docs.where("doc_id % 13 = 0"))
    labels = labels.unionByName(labels.where("doc_id % 5 = 0").withColumn("quality", 1 - F.col("quality")))
    results = []
    for partitions, order in ((4, "text"), (9, "doc_id"), (200, "n_chars")):
        with session_conf(spark, spark__sql__shuffle__partitions=str(partitions)):
            got = quality.held_out_quality(docs.repartition(partitions).sortWithinPartitions(order), labels.repartition(partitions % 7 + 1))
            results.append(sorted(map(tuple, got.collect())))
    assert results[0] == results[1] == results[2]


def _cosine(a, b):
    a, b = (np.longdouble(x) for x in (a, b))
    return float((a * b).sum() / np.sqrt((a * a).sum()) / np.sqrt((b * b).sum()))


@pytest.mark.parametrize("sizes", [(1e-200,) * 3, (1e200,) * 3, (1e-300, 1.0, 1e300), (5e-324, 1e-310, 1.7e308)])
def test_vectors_of_extreme_size(spark, sizes):
    rng = np.random.default_rng(2)
    base = [(rng.integers(1, 4, 6) * rng.choice([-1, 1], 6)).astype(float) for _ in range(9)]
    vectors = [v / 3 * sizes[i % 3] if sizes[i % 3] > 1e-300 else np.sign(v) * sizes[i % 3] for i, v in enumerate(base)]
    table = spark.createDataFrame([(50 * (i % 2) + i * 100, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    ids = {50 * (i % 2) + i * 100: v for i, v in enumerate(vectors)}
    got = neighbours.nearest(table).collect()
    assert len(got) == 9 * 5
    for r in got:
        assert r.score == pytest.approx(_cosine(ids[r.query_id], ids[r.vec_id]), abs=1e-12)


def test_scaling_changes_no_bit():
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(200, 16))
    small = neighbours.scaled(vectors)
    plain = (vectors[:100] * vectors[100:]).sum(1) / (np.sqrt((vectors[:100] ** 2).sum(1)) * np.sqrt((vectors[100:] ** 2).sum(1)))
    again = (small[:100] * small[100:]).sum(1) / (np.sqrt((small[:100] ** 2).sum(1)) * np.sqrt((small[100:] ** 2).sum(1)))
    assert (plain == again).all() and (np.abs(small).max(1) < 1).all() and (np.abs(small).max(1) >= 0.5).all()
