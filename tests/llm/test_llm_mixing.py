"""The schedule and the words taken against a plain replay."""

import numpy as np
import pytest

from cinelake.llm import mixing
from tests.llm.helpers import WORD

SCHEMA = "doc_id long, text string, source string, part long, k string"


def _rows(seed=1):
    rng = np.random.default_rng(seed)
    names = ["b", "a", None, "", "é"]
    out = []
    for i in range(300):
        source = "a" if rng.random() < 0.4 else names[int(rng.integers(5))]
        out.append((i, "w " * int(rng.integers(0, 40)) if i % 17 else None, source, 1, "x"))
    return out


def test_targets_share_the_excess():
    got = mixing.targets(np.array([100, 10, 1000, 0]), np.array([3.0, 3.0, 1.0, 5.0]), 1.5, 2.0)
    assert got[0] == 200 and got[1] == 20 and got[3] == 0 and got.sum() == pytest.approx(1665)
    assert mixing.targets(np.zeros(0, int), np.zeros(0), 1.5, 2.0).size == 0


def test_words_taken(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in mixing.mix(df.repartition(5), (3, 1, 2), 1.5, 2.0, block_words=8).collect()}
    again = {r.doc_id: r for r in mixing.mix(df.repartition(2), (3, 1, 2), 1.5, 2.0, block_words=8).collect()}
    assert got == again and len(got) == len(rows)
    sizes, sums = {}, {}
    for i, text, source, *_ in rows:
        assert got[i].size == len(WORD.findall(text or "")) and 0 <= got[i].taken <= 2 * got[i].size and got[i].copies <= 2
        sizes[source] = sizes.get(source, 0) + got[i].size
        sums[source] = sums.get(source, 0) + got[i].taken
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = mixing.targets(np.array([sizes[s] for s in order]), np.array([3.0, 1.0, 2.0, 3.0, 1.0]), 1.5, 2.0)
    for source, target in zip(order, want, strict=True):
        row = next(r for r in got.values() if r.source == source)
        assert row.source_size == sizes[source] and row.target == pytest.approx(target)
        assert abs(sums[source] - target) <= 0.5 + 1e-9
    # a source whose target is its size and a rest: every document once, some twice
    assert all(got[i].taken >= got[i].size for i, _, s, *_ in rows if want[order.index(s)] >= sizes[s])


def test_schedule_keeps_near_the_shares(spark):
    shares, quotas = np.array([60.0, 30.0, 0.0, 10.0]), np.array([600, 300, 0, 100])
    rows = sorted(mixing.schedule(spark, shares, quotas).collect(), key=lambda r: r.slot)
    for k, quota in enumerate(quotas.tolist()):
        assert sorted(r["rank"] for r in rows if r.k == k) == list(range(quota))
    for upto in (50, 200, 500, 900):
        taken = np.bincount([r.k for r in rows[:upto]], minlength=4)
        assert np.abs(taken - upto * shares / 100).max() <= 5


def test_nothing_to_mix(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(none, (3, 1, 2), 1.5, 2.0).count() == 0
    blank = spark.createDataFrame([(1, None, None, 0, ""), (2, " ", "a", 0, "")], SCHEMA)
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(blank, (3, 1, 2), 1.5, 2.0).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_rows_with_null_and_repeated_ids_are_documents(spark):
    rng = np.random.default_rng(4)
    rows = [(None if i % 3 == 0 else i % 20, "w " * int(rng.integers(0, 40)), "ab"[i % 2], 1, "x") for i in range(120)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA), (3, 1), 1.5, 2.0, block_words=16).collect()
    key = lambda i, source, size: (i is None, i or 0, source, size)
    assert sorted(key(r.doc_id, r.source, r.size) for r in got) == sorted(key(i, s, len(t.split())) for i, t, s, _, _ in rows)
    assert all(0 <= r.taken <= 2 * r.size and r.copies <= 2 for r in got)
    for source in "ab":
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.5
