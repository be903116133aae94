"""Periodic runs of words, found through a recompressed grammar of each text.

The word sequences of a slice of documents, parted by unique separators, are
recompressed: block compression turns every maximal repetition of one symbol
into a symbol, pair compression does the same with the pairs that lead from a
left to a right half of the alphabet, alternately, until each document is one
symbol. Equal symbols stand for equal words, and whether a symbol begins its
parent depends on its neighbours only, so the levels answer longest common
extensions in both directions: rise while both sides begin a parent, walk while
the symbols agree, and descend into the first two that differ.

A run of period ``q`` and at least ``repeats`` periods matches itself at distance
``q`` on a stretch of ``(repeats - 1) * q`` words, which holds a multiple of that
number. Those multiples are the candidates, over all ``q`` a harmonic sum, and two
extensions of each give its whole run. No suffix array is built.

Documents are rows of one DataFrame and never leave their task; a slice is
``SLICE_BYTES`` of text, or one longer document, and candidates are taken in
blocks, so memory grows with the longest document only (linearly).

Defined results: a row is a document, whatever its ``doc_id`` (null or repeated
ids are carried along); null and empty texts have no words and no runs; of equal
stretches the smallest period is reported; an empty table gives no rows; only
``doc_id`` and ``text`` are read, further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package
from cinelake.llm.text import mix, slices, utf8, word_array

#: A run has at least this many words, and this many periods.
LEAST_WORDS, REPEATS = 6, 4
#: Candidates handled at a time.
CANDIDATES = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Grammar:
    """Levels of a recompressed sequence, the first one the sequence itself.

    ``symbols[l]``: the symbols of level ``l``; ``up[l]``: for each the place of
    its parent on level ``l + 1``; ``first[l]``: for each the place of its first
    child on level ``l - 1``, and one entry more; ``blocks[l]``: whether level
    ``l + 1`` came by block compression. Negative symbols are separators: each
    occurs once and is never compressed.
    """

    def __init__(self, sequence: np.ndarray):
        self.symbols, self.up, self.first, self.blocks = [sequence], [], [None], []
        fresh, turn = int(sequence.max(initial=0)) + 1, 0
        while self._joined(self.symbols[-1]):
            fresh = self._block_level(fresh)
            fresh = self._pair_level(fresh, turn)
            turn += 1

    @staticmethod
    def _joined(s: np.ndarray) -> bool:
        """Whether two neighbours are left that may be compressed."""
        return bool(((s[1:] >= 0) & (s[:-1] >= 0)).any())

    def _add(self, starts: np.ndarray, symbols: np.ndarray, block: bool) -> None:
        self.up.append(np.cumsum(starts) - 1)
        self.first.append(np.append(np.flatnonzero(starts), len(starts)))
        self.symbols.append(symbols)
        self.blocks.append(block)

    def _block_level(self, fresh: int) -> int:
        s = self.symbols[-1]
        starts = np.ones(len(s), bool)
        starts[1:] = s[1:] != s[:-1]
        if starts.all():
            return fresh
        at = np.flatnonzero(starts)
        length = np.diff(np.append(at, len(s)))
        symbols, long = s[at], length > 1
        key, name = np.unique(symbols[long] * (int(length.max()) + 1) + length[long], return_inverse=True)
        symbols[long] = fresh + name
        self._add(starts, symbols, True)
        return fresh + len(key)

    def _pair_level(self, fresh: int, turn: int) -> int:
        s = self.symbols[-1]
        side = (mix(s.astype(np.uint64) + np.uint64((turn + 1) << 40)) & np.uint64(1)).astype(bool)
        both = (s[:-1] >= 0) & (s[1:] >= 0) & (side[:-1] != side[1:])
        ahead = both & side[1:]  # from the left half to the right one
        back = both & side[:-1]
        pairs = ahead if np.count_nonzero(ahead) >= np.count_nonzero(back) else back
        if not pairs.any():
            return fresh
        starts = np.ones(len(s), bool)
        starts[1:] = ~pairs
        heads = np.flatnonzero(pairs)
        key, name = np.unique(s[heads] * fresh + s[heads + 1], return_inverse=True)
        symbols = s.copy()
        symbols[heads] = fresh + name
        self._add(starts, symbols[starts], False)
        return fresh + len(key)

    def _walk(self, level: int, i: np.ndarray, j: np.ndarray, ahead: bool) -> np.ndarray | int:
        """How far both sides may go on from two equal symbols: one symbol, or to
        the nearer end of a block."""
        if level == len(self.up) or not self.blocks[level]:
            return 1
        up, first = self.up[level], self.first[level + 1]
        if ahead:
            return np.minimum(first[up[i] + 1] - i, first[up[j] + 1] - j)
        return np.minimum(i - first[up[i]], j - first[up[j]]) + 1

    def extend(self, x: np.ndarray, y: np.ndarray, ahead: bool = True) -> np.ndarray:
        """For each pair of different places of the sequence, how many symbols
        agree from there on (these included), ahead or backwards."""
        i, j, sign = x.copy(), y.copy(), 1 if ahead else -1
        stopped = np.full(len(x), -1)
        level, alive = 0, np.arange(len(x))
        while len(alive):
            symbols, risen, work = self.symbols[level], [], alive
            while len(work):
                a, b = i[work], j[work]
                same = symbols[a] == symbols[b]
                stopped[work[~same]] = level
                work, a, b = work[same], a[same], b[same]
                if level < len(self.up):
                    up = self.up[level]
                    # Both at an end of their parents: the parents can be compared.
                    rise = (up[a - sign] != up[a]) & (up[b - sign] != up[b])
                    risen.append(work[rise])
                    work, a, b = work[~rise], a[~rise], b[~rise]
                step = sign * self._walk(level, a, b, ahead)
                i[work], j[work] = a + step, b + step
            alive = np.concatenate(risen) if risen else work
            if len(alive):
                i[alive], j[alive] = self.up[level][i[alive]], self.up[level][j[alive]]
                level += 1
        for level in range(level, 0, -1):
            work = np.flatnonzero(stopped >= level)
            first, symbols = self.first[level], self.symbols[level - 1]
            if ahead:
                i[work], j[work] = first[i[work]], first[j[work]]
            else:
                i[work], j[work] = first[i[work] + 1] - 1, first[j[work] + 1] - 1
            while len(work):
                work = work[symbols[i[work]] == symbols[j[work]]]
                a, b = i[work], j[work]
                step = sign * self._walk(level - 1, a, b, ahead)
                i[work], j[work] = a + step, b + step
        return sign * (i - x)


def candidates(counts: np.ndarray, repeats: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (document, period, place): the multiples of ``(repeats - 1) * q``
    in each document, for every period ``q`` of which it can hold ``repeats``."""
    most = counts // repeats
    doc = np.repeat(np.arange(len(counts)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    places = (counts[doc] - 1 - period) // ((repeats - 1) * period) + 1
    ends = np.cumsum(places)
    lo = 0
    while lo < len(doc):
        before = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + CANDIDATES, side="right")))
        each = places[lo:hi]
        d, q = np.repeat(doc[lo:hi], each), np.repeat(period[lo:hi], each)
        turn = np.arange(len(d)) - np.repeat(np.cumsum(each) - each, each)
        yield d, q, turn * (repeats - 1) * q
        lo = hi


def runs_of(names: np.ndarray, counts: np.ndarray, least: int, repeats: int) -> tuple[np.ndarray, ...]:
    """All runs of the documents whose words' ``names`` (0, 1, …) follow each other,
    ``counts`` of each: arrays (document, start, length, period), by document,
    start and period."""
    # A separator stands before every document and one behind the last.
    base = np.cumsum(counts) - counts + np.arange(1, len(counts) + 1)
    sequence = np.empty(len(names) + len(counts) + 1, np.int64)
    at = np.ones(len(sequence), bool)
    at[base - 1] = at[-1] = False
    sequence[at] = names
    sequence[~at] = -1 - np.arange(len(counts) + 1)
    grammar = None
    found = [np.empty((0, 4), np.int64)]
    for d, q, place in candidates(counts, repeats):
        x = base[d] + place
        like = np.flatnonzero(sequence[x] == sequence[x + q])
        if not len(like):
            continue
        grammar = grammar or Grammar(sequence)
        d, q, x = d[like], q[like], x[like]
        after = grammar.extend(x, x + q)
        before = grammar.extend(x - 1, x + q - 1, ahead=False)
        length = q + before + after
        long = length >= np.maximum(least, repeats * q)
        rows = np.stack([d, x - before - base[d], length, q], axis=1)[long]
        found.append(np.unique(rows, axis=0) if len(rows) else rows)
    rows = np.concatenate(found)
    # Of one stretch the smallest period, then by start and period.
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return tuple(rows.T)


def _scan(least: int, repeats: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                words, counts = word_array(data[offsets[a] : offsets[b]], offsets[a : b + 1])
                names = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
                doc, start, length, period = runs_of(names, counts, least, repeats)
                # Words covered by a run behind its first period are dropped.
                base = np.cumsum(counts) - counts
                edge = np.zeros(len(names) + 1, np.int64)
                np.add.at(edge, base[doc] + start + period, 1)
                np.add.at(edge, base[doc] + start + length, -1)
                kept = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                ends = np.searchsorted(kept, np.append(base, len(names)))
                left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(kept)))
                fields = [pa.array(v, pa.int64()) for v in (start, length, period)]
                each = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=b - a))]).astype(np.int32)
                runs = pa.ListArray.from_arrays(pa.array(each), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                text = pc.binary_join(left, pa.scalar(b" ", pa.large_binary())).cast(pa.string())
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), runs, text]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return scan


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, repeats: int = REPEATS) -> DataFrame:
    """``(doc_id, n_words, runs, collapsed)`` of every row of ``docs``.

    ``runs``: all stretches of at least ``least`` words and ``repeats`` (2 or more)
    smallest periods that cannot be extended, by start and period; words are
    numbered from 0. ``collapsed``: the words that no run covers behind its first
    period, joined by one space.
    """
    if repeats < 2:
        raise ValueError("a run has at least two periods")
    ship_package(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_scan(least, repeats), f"doc_id long, n_words long, runs {RUNS}, collapsed string")


def plant_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with a repetition planted in every tenth document by id
    hash ``h``: from word ``a = g % n`` on its words repeat with period
    ``1 + (n - a) div (3 + g % 8)``, ``g`` being ``h div 10``. Rows without an id or
    words stay as they are."""
    words = F.expr(r"filter(split(text, '[\\x20\\x09-\\x0D]+'), w -> w <> '')")
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", "text", h.alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    rows = rows.withColumn("n", F.size("words").cast("long")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = "transform(sequence(cast(0 AS bigint), n - a - 1), i -> words[cast(a + i % p AS int)])"
    planted = F.expr(f"array_join(concat(slice(words, 1, cast(a AS int)), {tail}), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def run_rows(docs: DataFrame) -> DataFrame:
    """Runs of ``docs`` as counts, the longest run and digests, one row per row."""
    longest = F.array_max(F.expr("transform(runs, r -> struct(r.length, -r.start AS start, -r.period AS period))"))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = docs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), lines.alias("lines"), "collapsed")
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("top.start")).alias("start"),
        F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"),
        F.expr("(1000 * top.length) div (-top.period)").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
