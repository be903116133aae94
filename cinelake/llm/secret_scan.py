"""Secret scans: fixed patterns, and a comparison of character Markov models.

Patterns give the base spans. In what remains of runs of token characters, the
log-likelihood ratio of two first-order character models, one of random strings
and one of ordinary identifiers, decides: over the whole run, else over the
parts of it with the greatest sums, so that a secret counts whatever it is
attached to, and however short its run is. Both models are trained on labelled
samples: values of base spans (and generated strings of the usual alphabets, so
that a corpus without secrets has a model too) against distinct other runs. A
first model, whose ordinary runs are those of plain words and numbers, tells
which other runs are random; these are no samples of the ordinary. So sources
full of digests or encoded data do not hide secrets. Samples cover all documents.

Defined results: null and empty texts have no spans; texts are read whole;
spans are in code points, ends exclusive, and none from the models meets a base
span; empty tables give no rows; repeated rows repeat results; only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package
from cinelake.llm.text import slices, utf8

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
#: Shortest run that trains the model of identifiers, and that is scored.
TRAIN_LEAST = 8
#: Least log-likelihood ratio of a secret, in nats: of the run, of a character.
TOTAL_LEAST, MEAN_LEAST = 20.0, 0.9
#: What a character costs where parts of a run are sought, tried in turn.
COSTS = (0.0, 0.3, 0.6, MEAN_LEAST)
#: Runs of plain words and numbers.
PLAIN = re.compile(rb"(?:(?:[a-z]+|[A-Z]+|[A-Z][a-z]+|[0-9]+)(?:[+/_.=-]+|$))+")
GENERATED, SMOOTHING, SEED = 1500, 0.5, 11

ALPHABET = string.ascii_letters + string.digits + "+/_.=-"
START = len(ALPHABET)
CODE = np.full(256, -1, np.int64)
CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
TOKEN = CODE >= 0
HEX = np.zeros(256, bool)
HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end in ``data`` of runs of bytes in ``inside``."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    member = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = member[1:] != member[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    if cuts[-1] != len(data):
        cuts = np.append(cuts, len(data))
    starts, ends = cuts[:-1], cuts[1:]
    keep = member[starts] & (ends - starts >= least)
    starts, ends = starts[keep], ends[keep]
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def base_spans(text: str, low: str) -> list[tuple[str, int, int, int]]:
    """Base spans but for hex: kind, start, end and start of the value, in code points."""
    out = []
    if any(w in low for w in WORDS):
        out += [("assign", m.start(), m.end(), m.start(1)) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return out


def scan(column: pa.Array) -> Iterator[tuple[int, dict, np.ndarray, np.ndarray]]:
    """For parts of a column: first row; by row with base spans, the spans with
    where their value starts (in code points) and the text; bytes, with spaces for
    base spans; offsets of the rows in them."""
    data, offsets = utf8(column)
    for a, b in slices(offsets):
        part, off = data[offsets[a] : offsets[b]].copy(), offsets[a : b + 1] - offsets[a]
        hexes: dict[int, list] = {}
        for row, s, e in zip(*(x.tolist() for x in runs(part, off, HEX, HEX_LEAST)), strict=True):
            hexes.setdefault(row, []).append((s, e))
        base = {}
        for row, text in enumerate(column.slice(a, b - a).to_pylist()):
            if not text:
                continue
            found = base_spans(text, text.lower())
            for s, e in hexes.get(row, ()):
                at = place(part, off, row, s)
                found.append(("hex", at, at + e - s, at))
            if found:
                found.sort(key=lambda f: (f[1], KINDS.index(f[0])))
                base[row] = found, text
        for row, (found, text) in base.items():
            for f in found:
                s = off[row] + len(text[: f[1]].encode())
                part[s : s + len(text[f[1] : f[2]].encode())] = 0x20
        yield a, base, part, off


def place(part: np.ndarray, off: np.ndarray, row: int, at: int) -> int:
    """Code point of a row at a byte."""
    return int(np.count_nonzero((part[off[row] : at] & 0xC0) != 0x80))


def transitions(values: list[str]) -> np.ndarray:
    counts = np.zeros((START + 1) * START, np.int64)
    for value in values:
        code = CODE[np.frombuffer(value.encode(), np.uint8)]
        np.add.at(counts, np.concatenate([[START], code[:-1]]) * START + code, 1)
    return counts


def generated() -> list[str]:
    """Random strings of the usual alphabets."""
    draw = random.Random(SEED)
    kinds = ("0123456789abcdef", string.ascii_uppercase + "234567", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "_-")
    return ["".join(draw.choice(kinds[k % len(kinds)]) for _ in range(draw.randint(20, 64))) for k in range(GENERATED)]


def run_ratios(part: np.ndarray, starts: np.ndarray, ends: np.ndarray, model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ratios of the characters of all runs, one after the other; where runs begin."""
    length = ends - starts
    first = np.cumsum(length) - length
    code = CODE[part[np.repeat(starts - first, length) + np.arange(length.sum())]]
    before = np.empty_like(code)
    before[1:] = code[:-1]
    before[first] = START
    return model[before, code], first


def secret_parts(ratios: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, ratio) of the parts of a run that pass for secrets, from the
    ratios of its characters: the whole run, else parts with greatest sums."""
    out, todo = [], [(0, len(ratios))]
    while todo:
        a, b = todo.pop()
        r = ratios[a:b]
        if r[r > 0].sum() < TOTAL_LEAST:
            continue
        tried = [(0, b - a)]
        for cost in COSTS:
            sums = np.concatenate([[0.0], np.cumsum(r - cost)])
            end = int(np.argmax(sums - np.minimum.accumulate(sums)))
            tried.append((int(np.argmin(sums[: end + 1])), end))
        for s, e in tried:
            total = float(r[s:e].sum())
            if total >= TOTAL_LEAST and total >= MEAN_LEAST * (e - s):
                out.append((a + s, a + e, total))
                todo += [(a, a + s), (a + e, b)]
                break
    return sorted(out)


def _count_plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transitions of a task: label 1 values of base spans, 0 plain runs."""
    total = [np.zeros((START + 1) * START, np.int64) for _ in range(2)]
    for batch in batches:
        for _, base, part, off in scan(batch.column("text")):
            for found, text in base.values():
                total[1] += transitions([text[f[3] : f[2]] for f in found])
            _, starts, ends = runs(part, off, TOKEN, TRAIN_LEAST)
            raw = part.tobytes()
            plain = {v for v in {raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)} if PLAIN.fullmatch(v)}
            total[0] += _of_values(plain)
    yield from _rows_of(total)


def _of_values(values: Iterable[bytes]) -> np.ndarray:
    """Transitions of many values at once."""
    values = list(values)
    if not values:
        return np.zeros((START + 1) * START, np.int64)
    code = CODE[np.frombuffer(b"".join(values), np.uint8)]
    length = np.array([len(v) for v in values])
    before = np.empty_like(code)
    before[1:] = code[:-1]
    before[np.cumsum(length) - length] = START
    return np.bincount(before * START + code, minlength=(START + 1) * START)


def _rows_of(total: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for label, counts in enumerate(total):
        pair = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), label), pa.int64()), pa.array(pair, pa.int64()), pa.array(counts[pair], pa.int64())], ["label", "pair", "c"])


def _ordinary(first: np.ndarray):
    """Runs of a part that the first model does not call random, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part, off in scan(batch.column("text")):
                _, starts, ends = runs(part, off, TOKEN, TRAIN_LEAST)
                if not len(starts):
                    continue
                ratios, at = run_ratios(part, starts, ends, first)
                keep = np.add.reduceat(ratios, at) < MEAN_LEAST * (ends - starts)
                for k in np.flatnonzero(keep & (np.add.reduceat(np.maximum(ratios, 0), at) >= TOTAL_LEAST)).tolist():
                    keep[k] = not secret_parts(ratios[at[k] : at[k] + ends[k] - starts[k]])
                raw = part.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(sorted({raw[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)}), pa.binary())], ["run"])

    return run


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((START + 1) * START, np.int64)
    for batch in batches:
        total += _of_values(batch.column("run").to_pylist())
    yield from _rows_of([total])


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of every transition (random over ordinary)."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.col("text").cast("string").alias("text"))

    def summed(rows: DataFrame) -> np.ndarray:
        out = np.zeros((2, START + 1, START))
        for r in rows.groupBy("label", "pair").agg(F.sum("c").alias("c")).collect():  # at most two rows per pair of characters
            out[r.label, r.pair // START, r.pair % START] = r.c
        return out

    def ratios(counts: np.ndarray) -> np.ndarray:
        logs = np.log((counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=2, keepdims=True))
        return logs[1] - logs[0]

    schema = "label long, pair long, c long"
    counts = summed(texts.mapInArrow(_count_plain, schema))
    counts[1] += transitions(generated()).reshape(START + 1, START)
    ordinary = texts.mapInArrow(_ordinary(ratios(counts)), "run binary").distinct()
    counts[0] = summed(ordinary.mapInArrow(_count_runs, schema))[0]
    return ratios(counts)


def ratio(value: str, model: np.ndarray) -> float:
    code = CODE[np.frombuffer(value.encode(), np.uint8)]
    return float(model[np.concatenate([[START], code[:-1]]), code].sum())


def find_secrets(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``(doc_id, spans)`` per row; ``spans``: array of (kind, start, end, ratio)
    ordered by start, then kind as listed."""
    spark = docs.sparkSession
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("ratio", pa.float64())])
        for batch in batches:
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            for a, base, part, off in scan(batch.column("text")):
                for row, (found, text) in base.items():
                    spans[a + row] += [(k, s, e, ratio(text[v:e], model)) for k, s, e, v in found]
                rows, starts, ends = runs(part, off, TOKEN, TRAIN_LEAST)
                if len(rows):
                    ratios, at = run_ratios(part, starts, ends, model)
                    for k in np.flatnonzero(np.add.reduceat(np.maximum(ratios, 0), at) >= TOTAL_LEAST).tolist():
                        parts = secret_parts(ratios[at[k] : at[k] + ends[k] - starts[k]])
                        if parts:
                            first = place(part, off, rows[k], starts[k])
                            spans[a + rows[k]] += [("markov", first + s, first + e, score) for s, e, score in parts]
            for row, every in enumerate(spans):
                every.sort(key=lambda f: (f[1], KINDS.index(f[0])))
                spans[row] = [dict(zip(("kind", "start", "end", "ratio"), f, strict=True)) for f in every]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, pa.list_(item))], ["doc_id", "spans"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long, ratio: double>>")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_rows(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov)`` per row."""
    found = find_secrets(docs, train(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "markov")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), count("markov")
    )
