"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in both directions, labels every
position from both states, and a document's probabilities are the mean over its
positions. It is trained here, in numpy, by backpropagation through time on
windows of a bounded sample of labelled documents; prediction reads every byte
of every text, as windows with a margin of context on both sides, so memory is
bounded for texts of any length. Gates squash by ``x / (1 + |x|)``, which numpy
evaluates several times faster than exponentials.

Defined results: null text and text without a letter is ``und`` with score 0;
without any labelled document every document is; a null ``doc_id`` is not held
out; an empty table gives no rows; only ``doc_id``, ``text`` and, for training,
``lang`` are read; equal texts get equal predictions, ties the first label.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package
from cinelake.llm.text import slices, utf8

#: Bounds of the training sample: documents of each language, windows of a document.
SAMPLE_DOCS, SAMPLE_WINDOWS = 1500, 4
WINDOW, CONTEXT = 256, 16
HIDDEN, STEPS, LANES, LENGTH, RATE, SEED = 8, 220, 256, 96, 0.02, 7
UNKNOWN = "und"


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _slope(y: np.ndarray) -> np.ndarray:
    """Derivative of :func:`_squash` in terms of its value."""
    return (1 - np.abs(y)) ** 2


class ByteGru:
    """Parameters: per direction an input table ``W`` (256 × 3H; update, reset and
    candidate parts), recurrent ``U`` and output ``O``, and the output bias."""

    def __init__(self, labels: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.labels = labels
        h, k = HIDDEN, len(labels)
        self.p = {"b": np.zeros(k, np.float32)}
        for d in "fb":
            self.p["W" + d] = rng.normal(0, 0.5, (256, 3 * h)).astype(np.float32)
            self.p["U" + d] = rng.normal(0, 0.4, (h, 3 * h)).astype(np.float32)
            self.p["O" + d] = rng.normal(0, 0.4, (h, k)).astype(np.float32)

    def states(self, x: np.ndarray, d: str):
        """States after each position of ``x`` (positions × lanes), in reading
        order of direction ``d``, and what the gradients need."""
        w, u, h2 = self.p["W" + d], self.p["U" + d], 2 * HIDDEN
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        out, tape = np.empty((*x.shape, HIDDEN), np.float32), []
        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            gx, gh = np.take(w, x[t], axis=0), h @ u
            s = _squash(gx[:, :h2] + gh[:, :h2])
            g = 0.5 + 0.5 * s
            z, r = g[:, :HIDDEN], g[:, HIDDEN:]
            c = _squash(gx[:, h2:] + r * gh[:, h2:])
            tape.append((t, h, s, z, r, c, gh[:, h2:]))
            h = out[t] = c + z * (h - c)
        return out, tape

    def read(self, x: np.ndarray, outside: list[np.ndarray], d: str) -> np.ndarray:
        """The same states without the tape, in reused buffers; the lanes that are
        outside of their text at a position start anew."""
        cut = (slice(0, HIDDEN), slice(HIDDEN, 2 * HIDDEN), slice(2 * HIDDEN, None))
        wz, wr, wc = (np.ascontiguousarray(self.p["W" + d][:, k]) for k in cut)
        uz, ur, uc = (np.ascontiguousarray(self.p["U" + d][:, k]) for k in cut)
        lanes = x.shape[1]
        out = np.empty((len(x), lanes, HIDDEN), np.float32)
        h = np.zeros((lanes, HIDDEN), np.float32)
        z, r, c, a, m = (np.empty((lanes, HIDDEN), np.float32) for _ in range(5))

        def squash(y):
            np.abs(y, out=a)
            np.add(a, 1, out=a)
            np.divide(y, a, out=y)

        for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
            at = x[t]
            for gate, w, u in ((z, wz, uz), (r, wr, ur)):
                np.take(w, at, axis=0, out=gate, mode="clip")
                np.matmul(h, u, out=m)
                np.add(gate, m, out=gate)
                squash(gate)
                np.multiply(gate, 0.5, out=gate)
                np.add(gate, 0.5, out=gate)
            np.take(wc, at, axis=0, out=c, mode="clip")
            np.matmul(h, uc, out=m)
            np.multiply(m, r, out=m)
            np.add(c, m, out=c)
            squash(c)
            np.subtract(h, c, out=m)
            np.multiply(m, z, out=m)
            np.add(c, m, out=m)
            h = out[t]
            np.copyto(h, m)
            if len(outside[t]):
                h[outside[t]] = 0
        return out

    def probabilities(self, x: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Labels × positions × lanes."""
        k, at = len(self.labels), x.astype(np.intp)
        outside = [np.flatnonzero(~row) for row in inside]
        logits = np.ascontiguousarray((self.read(at, outside, "f").reshape(-1, HIDDEN) @ self.p["Of"]).T)
        logits += (self.read(at, outside, "b").reshape(-1, HIDDEN) @ self.p["Ob"]).T
        logits += self.p["b"][:, None]
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits.reshape(k, *x.shape)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its gradients."""
        runs = {d: self.states(x, d) for d in "fb"}
        logits = runs["f"][0] @ self.p["Of"] + runs["b"][0] @ self.p["Ob"] + self.p["b"]
        logits -= logits.max(axis=2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=2, keepdims=True)
        lanes = np.arange(x.shape[1])
        loss = float(-np.log(prob[:, lanes, y] + 1e-9).mean())
        prob[:, lanes, y] -= 1
        dl = prob / (x.shape[0] * x.shape[1])
        grad = {"b": dl.sum(axis=(0, 1))}
        for d in "fb":
            out, tape = runs[d]
            grad["O" + d] = np.tensordot(out, dl, axes=((0, 1), (0, 1)))
            dstate, u = dl @ self.p["O" + d].T, self.p["U" + d]
            gw, gu = np.zeros_like(self.p["W" + d]), np.zeros_like(u)
            dh = np.zeros_like(out[0])
            for t, h, s, z, r, c, ghc in reversed(tape):
                dh = dh + dstate[t]
                dc = dh * (1 - z) * _slope(c)
                ds = np.concatenate([dh * (h - c), dc * ghc], axis=1) * 0.5 * _slope(s)
                dgh = np.concatenate([ds, dc * r], axis=1)
                dgx = np.concatenate([ds, dc], axis=1)
                np.add.at(gw, x[t], dgx)
                gu += h.T @ dgh
                dh = dh * z + dgh @ u.T
            grad["W" + d], grad["U" + d] = gw, gu
        return loss, grad


def train(windows: list[tuple[bytes, str]], seed: int = SEED) -> ByteGru | None:
    """Adam over batches balanced by label; windows shorter than LENGTH repeat."""
    labels = sorted({lang for _, lang in windows})
    if not labels:
        return None
    net, rng = ByteGru(labels, seed), np.random.default_rng(seed)
    by = [np.array([np.resize(np.frombuffer(w, np.uint8), LENGTH) for w, lang in windows if lang == k]) for k in labels]
    if len(labels) == 1:
        return net
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(a) for k, a in net.p.items()}
    y = np.arange(LANES) % len(labels)
    for step in range(1, STEPS + 1):
        x = np.stack([by[k][rng.integers(len(by[k]))] for k in y], axis=1)
        _, grad = net.gradients(x, y)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in grad.items():
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            net.p[k] = (net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return net


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def lanes_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows with context over all rows: bytes and inside mask (positions ×
    lanes), which positions a lane answers for, and each lane's row."""
    lengths = np.diff(offsets)
    count = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), count)
    k = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = np.arange(-CONTEXT, WINDOW + CONTEXT)[:, None] + k * WINDOW
    inside = (at >= 0) & (at < lengths[row])
    x = data[np.where(inside, at + offsets[:-1][row], 0)]
    core = inside.copy()
    core[:CONTEXT] = core[-CONTEXT:] = False
    return x, inside, core, row


def predict(net: ByteGru, column: pa.Array) -> tuple[list[str], np.ndarray]:
    """Label and probability of each text of a column."""
    data, offsets = utf8(column)
    n, k = len(offsets) - 1, len(net.labels)
    sums = np.zeros((n, k))
    for a, b in slices(offsets):
        for lo in range(a, b, 1 << 12):
            hi = min(b, lo + (1 << 12))
            x, inside, core, row = lanes_of(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            for c in range(0, x.shape[1], 1 << 12):
                part = slice(c, c + (1 << 12))
                prob = net.probabilities(x[:, part], inside[:, part])
                np.add.at(sums[lo:hi], row[part], (prob * core[:, part]).sum(axis=1, dtype=np.float64).T)
    mean = sums / np.maximum(1, np.diff(offsets))[:, None]
    best = mean.argmax(axis=1)
    score = np.clip(mean[np.arange(n), best], 0.0, 1.0)
    found = [net.labels[i] for i in best]
    for i, text in enumerate(column.to_pylist()):
        if text is None or not has_letter(text):
            found[i], score[i] = UNKNOWN, 0.0
    return found, score


@lru_cache(maxsize=2)
def _network(raw: bytes) -> ByteGru | None:
    return pickle.loads(raw)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to SAMPLE_WINDOWS evenly spaced windows of each text, those with letters."""
    for batch in batches:
        ids, langs, out = [], [], []
        for i, lang, text in zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            raw = text.encode()
            spots = np.unique(np.linspace(0, max(0, len(raw) - LENGTH), SAMPLE_WINDOWS).astype(int))
            for at in spots.tolist():
                piece = raw[at : at + LENGTH]
                if has_letter(piece.decode(errors="ignore")):
                    ids.append(i)
                    langs.append(lang)
                    out.append(piece)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(out, pa.binary())], ["doc_id", "lang", "piece"])


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def fit(docs: DataFrame, held_out_fold: int = 2) -> ByteGru | None:
    """Train on a sample of the labelled documents outside the held-out fold: of
    each language those of smallest id hash, SAMPLE_DOCS at most."""
    ship_package(docs.sparkSession)
    open_ = docs.where((fold(F.col("doc_id")) != held_out_fold) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ids = open_.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = ids.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= SAMPLE_DOCS).select("doc_id", "lang").distinct()
    texts = open_.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The chosen ids are bounded by SAMPLE_DOCS for each language.
    sample = texts.join(F.broadcast(chosen), "doc_id").mapInArrow(_windows, "doc_id long, lang string, piece binary")
    rows = sorted((r.doc_id, r.lang, bytes(r.piece)) for r in sample.collect())
    return train([(piece, lang) for _, lang, piece in rows])


def language_of(spark: SparkSession, net: ByteGru | None) -> Callable[[Column], Column]:
    """A column function: text → struct of ``lang_pred`` and ``score``."""
    ship_package(spark)
    shared = spark.sparkContext.broadcast(pickle.dumps(net))  # about 60 kB

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        model, column = _network(shared.value), pa.Array.from_pandas(texts, type=pa.string())
        found, score = predict(model, column) if model else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
        return pd.DataFrame({"lang_pred": found, "score": score})

    return of


def language_rows(docs: DataFrame, held_out_fold: int = 2) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row."""
    of = language_of(docs.sparkSession, fit(docs, held_out_fold))
    found = docs.select("doc_id", of(F.col("text").cast("string")).alias("language"))
    held = F.coalesce(fold(F.col("doc_id")) == held_out_fold, F.lit(False))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "language.lang_pred", "language.score")
