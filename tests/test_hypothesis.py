"""Hypothesis-generated inputs for the two order-sensitive operators:
upsert (last row wins, absent keys kept) and the priority-quota cascade
(equal to the sequential greedy scan)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cinelake.operators import sampling, upsert
from tests.test_properties import _greedy, _replay_upsert

_SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.integers(min_value=0, max_value=15)


@_SETTINGS
@given(
    base=st.dictionaries(keys, st.text(alphabet="abc", min_size=1, max_size=3), max_size=10),
    batch=st.lists(st.tuples(keys, st.text(alphabet="xyz", min_size=1, max_size=3)), max_size=20),
)
def test_upsert_property(spark, base, batch):
    base_rows = sorted(base.items())
    batch_rows = [(k, v, pos) for pos, (k, v) in enumerate(batch)]
    b = spark.createDataFrame(base_rows, "k int, v string")
    n = spark.createDataFrame(batch_rows, "k int, v string, pos int")
    got = sorted(tuple(r) for r in upsert.upsert(b, n, "k", "pos").collect())
    assert got == _replay_upsert(base_rows, batch_rows)


genres = st.lists(st.sampled_from(["Action", "Sci-Fi", "Comedy", "Drama"]), max_size=3, unique=True)


@_SETTINGS
@given(
    texts=st.dictionaries(st.sampled_from([f"t{i}" for i in range(10)]), genres, min_size=1),
    order=st.lists(st.integers(min_value=0, max_value=9), min_size=1, max_size=30),
    quota=st.integers(min_value=1, max_value=3),
)
def test_quota_cascade_property(spark, texts, order, quota):
    ids = sorted(texts)
    cands = [(ids[i % len(ids)], ", ".join(texts[ids[i % len(ids)]]), pos) for pos, i in enumerate(order)]
    df = spark.createDataFrame(cands, "id string, genre string, pos int")
    targets = ["Action", "Sci-Fi", "Comedy"]
    got = sorted((r.id, r.target) for r in sampling.quota_select(df, targets, quota).collect())
    assert got == _greedy(cands, targets, quota)
