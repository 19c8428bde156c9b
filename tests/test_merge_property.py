"""merge_by_key against a plain model: every new row, plus the old rows
whose key is not among the new keys (a null key matches nothing)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfwise.operators.ingest import merge_by_key

rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3)), max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows, rows)
def test_merge_matches_model(spark, old, new):
    schema = "k int, v int"
    old_df = spark.createDataFrame([(k, 10 + v) for k, v in old], schema)
    new_df = spark.createDataFrame([(k, 20 + v) for k, v in new], schema)
    got = Counter(tuple(r) for r in merge_by_key(old_df, new_df, "k").collect())
    new_keys = {k for k, _ in new if k is not None}
    want = Counter([(k, 20 + v) for k, v in new] + [(k, 10 + v) for k, v in old if k is None or k not in new_keys])
    assert got == want
