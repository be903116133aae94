"""Nearest neighbours and language ID: recall, accuracy, gradients, edges."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from cinelake.llm import language_id, rp_forest
from tests.conftest import SF_CHECK
from tests.llm.helpers import documents

SCHEMA = "vec_id long, embedding array<float>, vid long, d double"


def _exact(rows, every, k):
    fine = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    length = max(sorted({len(v) for v in fine.values()}), key=lambda n: sum(len(v) == n for v in fine.values()), default=0)
    fine = {i: v for i, v in fine.items() if len(v) == length}
    out = {}
    for q, v in fine.items():
        if q % every == 0:
            near = sorted((float(np.sqrt(((v - w) ** 2).sum())), i) for i, w in fine.items() if i != q)[:k]
            out[q] = [(rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    return out


def _found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def _same(got, want):
    assert set(got) == set(want)
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]]
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in want[q]], rtol=1e-12, atol=0)


def _table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5) for i, v in rows], SCHEMA).repartition(3)


def test_small_tables_are_exact_with_ties_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(0, 3, 4)]) for i in range(150)]
    rows += [(i, [1.0, 2.0, 0.0, 1.0]) for i in range(200, 290)]  # a very common vector
    rows += [(300, None), (310, [0.0] * 4), (320, [1.0, None, 2.0, 3.0]), (330, [float("nan")] * 4), (340, [float("inf")] * 4), (350, [1.0]), (360, [])]
    rows = [(i, v) for i, v in rows if v is None or len(v) != 4 or i >= 300 or any(v)]
    got = rp_forest.nearest_neighbours(_table(spark, [*rows, rows[5]]), 10, 10)
    _same(_found(got), _exact(rows, 10, 10))


def test_fewer_candidates_than_k_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    _same(_found(rp_forest.nearest_neighbours(_table(spark, rows), 100, 10)), _exact(rows, 100, 10))
    assert rp_forest.nearest_neighbours(_table(spark, rows).where("vec_id > 9"), 100, 10).count() == 0
    assert rp_forest.nearest_neighbours(_table(spark, rows[:1]), 100, 10).count() == 0


def test_recall_with_many_leaves(spark, monkeypatch):
    """Trees of many small leaves (fitted on the driver here) visit a share of them."""
    monkeypatch.setattr(rp_forest, "LEAF", 256)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3000, 16))
    trees = [rp_forest.Tree(vectors, s, leaf=32) for s in range(rp_forest.TREES)]
    members = [[np.flatnonzero(t.leaf_of(vectors) == leaf) for leaf in range(t.leaves)] for t in trees]
    assert all(sum(map(len, m)) == 3000 for m in members)
    count = int(np.ceil(rp_forest.SHARE * sum(t.leaves for t in trees)))
    hits = 0
    for q in range(0, 3000, 100):
        d = ((vectors - vectors[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        seen = np.unique(np.concatenate([members[k][leaf] for k, leaf in rp_forest.probes(trees, vectors[q], count)]))
        hits += np.isin(np.argsort(d)[:10], seen).sum()
    assert hits / 300 >= 0.9


def test_gradients_are_those_of_the_loss():
    net = language_id.ByteGru(["a", "b", "c"])
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = np.random.default_rng(0).integers(0, 256, (7, 5)), np.array([0, 1, 2, 0, 1])
    _, grad = net.gradients(x, y)
    for name, value in net.p.items():
        at = (x[3, 2], 5) if name[0] == "W" else (0,) * value.ndim
        kept, step = value[at], 1e-3
        value[at] = kept + step
        up = net.gradients(x, y)[0]
        value[at] = kept - step
        down = net.gradients(x, y)[0]
        value[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(grad[name][at], rel=2e-2, abs=1e-6)


def test_reading_in_windows_covers_every_byte():
    texts = ["", "a", "x" * 255, "y" * 256, "z" * 257, "é" * 2000]
    data, offsets = language_id.utf8(pa.array(texts))
    _, inside, core, row = language_id.lanes_of(data, offsets)
    assert np.bincount(row, weights=core.sum(axis=0), minlength=len(texts)).tolist() == [len(t.encode()) for t in texts]
    assert (core <= inside).all()
    net = language_id.ByteGru(["a", "b"])
    alone = [language_id.predict(net, pa.array([t])) for t in texts]
    found, score = language_id.predict(net, pa.array(texts))
    assert found == [a[0][0] for a in alone] and np.allclose(score, [a[1][0] for a in alone], atol=1e-6)
    assert found[0] == "und" and score[0] == 0


def test_held_out_accuracy_and_texts_without_letters(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = language_id.language_rows(docs).collect()
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) >= 0.95


def test_nothing_to_learn_from(spark):
    rows = [(1, None), (2, "123 !!"), (3, "hello"), (None, "hello")]
    docs = documents(spark, rows)
    assert {r.lang_pred for r in language_id.language_rows(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()} == {"und"}
    got = sorted((str(r.doc_id), r.lang_pred) for r in language_id.language_rows(docs).collect())
    assert got == [("1", "und"), ("2", "und"), ("3", "en"), ("None", "en")]
    assert language_id.language_rows(docs.where("doc_id < 0")).count() == 0
