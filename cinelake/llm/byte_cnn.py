"""Quality scores by a convolutional network over bytes.

Learned filters of WIDTH bytes are laid on every position of a document. Their
responses are max-pooled in chunks of CHUNK cells of CELL bytes, each chunk
overlapping half of the next, and a small dense layer turns a chunk's pooled
filters and its fill into a logit. The mean over the document's chunks is its
logit; a calibrated sigmoid makes it one probability. The whole document is read,
in blocks of bounded memory.

The network is trained here, in numpy, by backpropagation through the pooled
positions on pieces of a bounded sample of labelled documents, balanced by label,
and calibrated on a part of the sample it has not seen, to the labels' shares.

Defined results: null text counts as empty, and an empty text is one chunk without
bytes; a null ``doc_id`` is not held out and carries no label; a ``doc_id`` with
both labels teaches nothing, and of repeated rows the smallest text is the one
learned from; without labels of both kinds every score is the share of label 1
(0.5 without any); an empty table gives no rows; only ``doc_id`` and ``text``, and
``doc_id`` and the label of the labels, are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package
from cinelake.llm.text import slices, utf8

#: Bounds of the training sample: documents of each label, pieces of a document.
SAMPLE_DOCS, SAMPLE_PIECES = 2000, 6
WIDTH, FILTERS, HIDDEN = 6, 16, 12
CELL, CHUNK, STRIDE = 64, 8, 4
STEPS, LANES, RATE, SEED = 500, 96, 0.02, 11
#: Half of the training pieces is cut to a random length of at least this.
LEAST_CUT = 10
#: The symbol of positions outside of a text.
PAD = 256
#: Positions convolved at a time.
BLOCK = 1 << 14


class ByteCnn:
    """Parameters: ``T`` (WIDTH × 257 × FILTERS, a filter's response to each byte at
    each of its places), dense ``A``, ``a`` and output ``v``, ``c``."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {
            "T": rng.normal(0, 0.3, (WIDTH, PAD + 1, FILTERS)).astype(np.float32),
            "A": rng.normal(0, 0.3, (FILTERS + 1, HIDDEN)).astype(np.float32),
            "a": np.zeros(HIDDEN, np.float32),
            "v": rng.normal(0, 0.3, HIDDEN).astype(np.float32),
            "c": np.zeros(1, np.float32),
        }
        self.p["T"][:, PAD] = 0
        self.scale = (1.0, 0.0)

    def responses(self, x: np.ndarray) -> np.ndarray:
        """Response of every filter at each position that has WIDTH symbols."""
        n, t = len(x) - WIDTH + 1, self.p["T"]
        out = np.take(t[0], x[:n], axis=0)
        part = np.empty_like(out)
        for w in range(1, WIDTH):
            np.take(t[w], x[w : w + n], axis=0, out=part, mode="clip")
            out += part
        return out

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Greatest response, at least 0, of the filters that end in each cell of
        ``x`` (whole cells)."""
        x = np.concatenate([np.full(WIDTH - 1, PAD, x.dtype), x])
        out = np.empty(((len(x) - WIDTH + 1) // CELL, FILTERS), np.float32)
        for lo in range(0, len(out) * CELL, BLOCK):
            r = self.responses(x[lo : min(lo + BLOCK, len(out) * CELL) + WIDTH - 1].astype(np.intp))
            r = r.reshape(-1, CELL, FILTERS)
            while r.shape[1] > 1:
                half = r.shape[1] // 2
                r = np.maximum(r[:, :half], r[:, half:])
            out[lo // CELL : lo // CELL + len(r)] = r[:, 0]
        return np.maximum(out, 0, out=out)

    def logits(self, pooled: np.ndarray, fill: np.ndarray) -> np.ndarray:
        q = np.concatenate([pooled, fill[:, None]], axis=1, dtype=np.float64)
        h = np.maximum(q @ self.p["A"] + self.p["a"], 0)
        return h @ self.p["v"] + self.p["c"][0]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy of pieces (one per row, CELL * CHUNK symbols) and its
        gradients, through the position of each filter's greatest response."""
        n, size = x.shape
        padded = np.concatenate([np.full((n, WIDTH - 1), PAD, x.dtype), x], axis=1)
        flat = np.append(padded.reshape(-1), np.full(WIDTH - 1, PAD, x.dtype))
        r = self.responses(flat).reshape(n, size + WIDTH - 1, FILTERS)[:, :size]
        at = r.argmax(axis=1)
        top = np.take_along_axis(r, at[:, None], axis=1)[:, 0]
        q = np.concatenate([np.maximum(top, 0), (x != PAD).mean(axis=1)[:, None]], axis=1)
        u = q @ self.p["A"] + self.p["a"]
        h = np.maximum(u, 0)
        z = h @ self.p["v"] + self.p["c"][0]
        loss = float((np.logaddexp(0, z) - y * z).mean())
        dz = (1 / (1 + np.exp(-z)) - y) / n
        du = np.outer(dz, self.p["v"]) * (u > 0)
        dtop = (du @ self.p["A"].T)[:, :FILTERS] * (top > 0)
        grad = {"A": q.T @ du, "a": du.sum(axis=0), "v": h.T @ dz, "c": np.array([dz.sum()])}
        grad["T"] = np.zeros(self.p["T"].shape)
        rows, filters = np.arange(n)[:, None], np.arange(FILTERS)[None, :]
        for w in range(WIDTH):
            np.add.at(grad["T"][w], (padded[rows, at + w], np.broadcast_to(filters, at.shape)), dtop)
        grad["T"][:, PAD] = 0
        return loss, grad

    def probability(self, logit: np.ndarray) -> np.ndarray:
        slope, shift = self.scale
        return 1 / (1 + np.exp(-np.clip(slope * logit + shift, -40, 40)))


def train(pieces: list[tuple[bytes, int]], seed: int = SEED) -> ByteCnn:
    """Adam over batches with as many pieces of either label."""
    net, rng = ByteCnn(seed), np.random.default_rng(seed)
    by = [np.stack([_symbols(p) for p, label in pieces if label == k]) for k in (0, 1)]
    m = {k: np.zeros(v.shape) for k, v in net.p.items()}
    s = {k: np.zeros(v.shape) for k, v in net.p.items()}
    y = np.repeat([0, 1], LANES // 2)
    for step in range(1, STEPS + 1):
        x = np.concatenate([b[rng.integers(0, len(b), LANES // 2)] for b in by])
        for i in range(0, LANES, 2):  # short texts are rare in a sample
            x[i, int(LEAST_CUT * (CELL * CHUNK / LEAST_CUT) ** rng.random()) :] = PAD
        _, grad = net.gradients(x, y)
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in grad.items():
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.99 * s[k] + 0.01 * g * g
            move = rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-6)
            net.p[k] = (net.p[k] - move).astype(np.float32)
    return net


def calibrate(net: ByteCnn, logit: np.ndarray, label: np.ndarray, share: float) -> None:
    """Slope and shift of the sigmoid: logistic regression of documents' labels on
    their logits, weighted to the ``share`` of label 1 (Newton's method, a weak
    prior keeps it finite where the labels are parted)."""
    x = np.stack([logit, np.ones(len(logit))], axis=1)
    ones = max(1, int(label.sum()))
    weight = np.where(label == 1, share / ones, (1 - share) / max(1, len(label) - ones)) * len(label)
    start = np.array([1.0, np.log(share / (1 - share))])
    b, prior = start.copy(), np.array([0.5, 0.05])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        slope = x.T @ (weight * (p - label)) + prior * (b - start)
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(prior)
        b = b - np.clip(np.linalg.solve(curve, slope), -1, 1)
    net.scale = (float(max(b[0], 0.05)), float(b[1]))


def _symbols(piece: bytes) -> np.ndarray:
    out = np.full(CELL * CHUNK, PAD, np.intp)
    out[: len(piece)] = np.frombuffer(piece, np.uint8)
    return out


def chunks_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each text, and for all chunks its text, first cell (in the text) and
    cell behind its last."""
    cells = np.maximum(1, -(-(lengths + WIDTH - 1) // CELL))
    count = np.maximum(1, -(-(cells - CHUNK) // STRIDE) + 1)
    row = np.repeat(np.arange(len(lengths)), count)
    first = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * STRIDE
    return cells, row, first, np.minimum(first + CHUNK, cells[row])


def document_logits(net: ByteCnn, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean logit over the chunks of each text."""
    lengths = np.diff(offsets)
    cells, row, first, last = chunks_of(lengths)
    base = np.cumsum(cells) - cells
    x = np.full(int(cells.sum()) * CELL, PAD, np.int16)
    x[np.repeat(base * CELL - (offsets[:-1] - offsets[0]), lengths) + np.arange(len(data))] = data
    pooled = np.concatenate([net.cells(x), np.zeros((1, FILTERS), np.float32)])
    spans = np.stack([base[row] + first, base[row] + last], axis=1).reshape(-1)
    pooled = np.maximum.reduceat(pooled, spans, axis=0)[::2]
    fill = np.clip(lengths[row] - first * CELL, 0, CHUNK * CELL) / (CHUNK * CELL)
    z = net.logits(pooled, fill)
    return np.bincount(row, weights=z, minlength=len(lengths)) / np.bincount(row, minlength=len(lengths))


@lru_cache(maxsize=2)
def _network(raw: bytes) -> ByteCnn | float:
    return pickle.loads(raw)


def _score(shared, threshold: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = _network(shared.value)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            out = np.full(batch.num_rows, net if isinstance(net, float) else 0.0)
            if isinstance(net, ByteCnn):
                for a, b in slices(offsets):
                    z = document_logits(net, data[offsets[a] : offsets[b]], offsets[a : b + 1])
                    out[a:b] = np.round(net.probability(z), 6)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(out), pa.array((out >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return score


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to SAMPLE_PIECES evenly spaced pieces of a chunk's size of each text."""
    for batch in batches:
        ids, labels, out = [], [], []
        for i, label, text in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "label", "text")), strict=True):
            raw = text.encode()
            for at in np.unique(np.linspace(0, max(0, len(raw) - CELL * CHUNK), SAMPLE_PIECES).astype(int)).tolist():
                ids.append(i)
                labels.append(label)
                out.append(raw[at : at + CELL * CHUNK])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int32()), pa.array(out, pa.binary())], ["doc_id", "label", "piece"])


def _fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out_fold: int = 0) -> ByteCnn | float:
    """A network trained on labelled documents outside the held-out fold: of each
    label those of smallest id hash, SAMPLE_DOCS at most. Without both labels, the
    share of label 1."""
    ship_package(docs.sparkSession)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    marks = marks.where(F.col("label").isin(0, 1) & (_fold(F.col("doc_id"), folds) != held_out_fold))
    marks = marks.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    counts = {r.label: r.n for r in marks.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    if len(counts) < 2:
        return float(share)
    chosen = None
    for k in (0, 1):
        part = marks.where(F.col("label") == k).select("doc_id", "label")
        part = part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
        chosen = part if chosen is None else chosen.unionAll(part)
    # At most 2 * SAMPLE_DOCS ids; of rows that repeat one, the smallest text.
    sample = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    rows = sorted((r.doc_id, r.label, bytes(r.piece)) for r in sample.mapInArrow(_pieces, "doc_id long, label int, piece binary").collect())
    docs_of = {label: sorted({i for i, k, _ in rows if k == label}) for label in (0, 1)}
    if not all(docs_of.values()):
        return float(share)
    # Every fifth document calibrates (all, if there are few).
    apart = {i for ids in docs_of.values() for i in (ids[::5] if len(ids) >= 10 else ids)}
    few = {i for ids in docs_of.values() for i in ids if len(ids) < 10}
    net = train([(piece, k) for i, k, piece in rows if i not in apart or i in few])
    pieces: dict[int, tuple[int, list[bytes]]] = {}
    for i, k, piece in rows:
        if i in apart:
            pieces.setdefault(i, (k, []))[1].append(piece)
    raw = b"".join(p for _, ps in pieces.values() for p in ps)
    offsets = np.cumsum([0] + [len(p) for _, ps in pieces.values() for p in ps])
    z = document_logits(net, np.frombuffer(raw, np.uint8), offsets)
    owner = np.repeat(np.arange(len(pieces)), [len(ps) for _, ps in pieces.values()])
    z = np.bincount(owner, weights=z) / np.bincount(owner)
    calibrate(net, z, np.array([k for k, _ in pieces.values()]), min(0.999, max(0.001, share)))
    return net


def quality_rows(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pickle.dumps(fit(docs, labels, "quality", folds, held_out_fold)))  # about 100 kB
    held = F.coalesce(_fold(F.col("doc_id").cast("long"), folds) == held_out_fold, F.lit(False))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_score(shared, threshold), "doc_id long, held_out boolean, score double, predicted int")
