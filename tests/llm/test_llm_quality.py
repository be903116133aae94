"""The byte network: gradients, coverage of whole texts, held-out accuracy."""

import zlib

import numpy as np
import pytest

from cinelake.llm import byte_cnn
from tests.conftest import SF_CHECK
from tests.llm.helpers import documents


def test_gradients_are_those_of_the_loss():
    net = byte_cnn.ByteCnn()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 123, (6, 512)), np.array([0, 1, 1, 0, 1, 0])
    x[2, 40:] = x[3, 300:] = byte_cnn.PAD
    _, grad = net.gradients(x, y)
    for name, value in net.p.items():
        spots = np.argsort(-np.abs(grad[name]).reshape(-1))[:3]
        for at in (np.unravel_index(k, value.shape) for k in spots):
            kept, step = value[at], 1e-5
            value[at] = kept + step
            up = net.gradients(x, y)[0]
            value[at] = kept - step
            down = net.gradients(x, y)[0]
            value[at] = kept
            assert (up - down) / (2 * step) == pytest.approx(grad[name][at], rel=1e-3, abs=1e-7)


def plain_logit(net, raw):
    """Filters, chunks and the dense layer by loops over one text."""
    cells = max(1, -(-(len(raw) + byte_cnn.WIDTH - 1) // byte_cnn.CELL))
    x = [byte_cnn.PAD] * (byte_cnn.WIDTH - 1) + list(raw) + [byte_cnn.PAD] * (cells * byte_cnn.CELL - len(raw))
    r = np.array([sum(net.p["T"][w, x[i + w]] for w in range(byte_cnn.WIDTH)) for i in range(cells * byte_cnn.CELL)])
    out, first = [], 0
    while True:
        last = min(first + byte_cnn.CHUNK, cells)
        pooled = np.maximum(r[first * byte_cnn.CELL : last * byte_cnn.CELL].max(axis=0), 0)
        size = byte_cnn.CELL * byte_cnn.CHUNK
        fill = min(max(len(raw) - first * byte_cnn.CELL, 0), size) / size
        h = np.maximum(np.append(pooled, fill) @ net.p["A"] + net.p["a"], 0)
        out.append(h @ net.p["v"] + net.p["c"][0])
        if last == cells:
            return np.mean(out)
        first += byte_cnn.STRIDE


def test_documents_are_read_whole(monkeypatch):
    monkeypatch.setattr(byte_cnn, "BLOCK", 128)
    rng = np.random.default_rng(5)
    raws = [rng.integers(32, 127, n).astype(np.uint8).tobytes() for n in (0, 1, 5, 58, 59, 60, 64, 300, 507, 508, 600, 1500)]
    net = byte_cnn.ByteCnn()
    offsets = np.cumsum([0] + [len(r) for r in raws])
    got = byte_cnn.document_logits(net, np.frombuffer(b"".join(raws), np.uint8), offsets)
    assert got == pytest.approx([plain_logit(net, r) for r in raws], abs=1e-5)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF_CHECK}/{t}.parquet") for t in ("documents", "labels"))
    quality = {r.doc_id: r.quality for r in labels.collect()}
    rows = byte_cnn.quality_rows(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([[a > b for b in bad] for a in good]) >= 0.97
    assert np.mean([s >= 0.3 for s in good]) >= 0.97


def test_missing_contradicting_and_repeated_labels(spark):
    rows = [(1, "a b c"), (1, "d"), (2, None), (3, ""), (None, "x"), (4, "y" * 100_000)]
    docs = documents(spark, rows)
    none = spark.createDataFrame([], "doc_id long, quality int, text string")
    assert {r.score for r in byte_cnn.quality_rows(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (None, 0), (3, 7), (4, None)], "doc_id long, quality int")
    got = byte_cnn.quality_rows(docs, ones).collect()  # 2 contradicts itself
    assert len(got) == len(rows) and {r.score for r in got} == {1.0}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    both = spark.createDataFrame([(1, 1), (4, 0)], "doc_id long, quality int")
    score = {(r.doc_id, r.score) for r in byte_cnn.quality_rows(docs, both).collect()}
    assert len(score) == len(rows) and all(0 <= s <= 1 for _, s in score)
    assert byte_cnn.quality_rows(docs.where("doc_id > 9"), both).count() == 0
