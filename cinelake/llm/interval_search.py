"""Ranked lexical search over posting lists with range-maximum sparse tables.

Documents are indexed in segments: one row holds the posting lists of a bounded
number of documents, each list in the segment's document order (documents that
share their most frequent term lie together). When a segment is searched, the
impacts of all its postings are computed once and a sparse table over them
answers, for any interval of a list, where its greatest impact lies.

A search keeps intervals of documents by their bound, the sum of the greatest
impacts of the item's lists inside it. The best ones are split at the document of
the greatest single impact, which is scored exactly, and their two rests go back
with their own bounds; the search ends when no bound reaches the last of the best
documents so far. Intervals of equal rank are opened in batches, so that one numpy
call serves all of them. A task keeps each item's best documents over all its
segments, and Spark merges the tasks' lists.

Two passes over the corpus's index and one over the texts; only postings of terms
that some item holds are kept. The items are a stated query set: their terms reach
the tasks in blocks of BLOCK_BYTES at most, one pass over the index for each block.

Defined results: every row is a document, whatever its ``doc_id`` (null ids order
last, repeated ids are listed each); null texts and texts without a term take no
part; rows that share an ``item_id`` are one item; an item without terms, or whose
terms no document holds, has no rows; empty tables give no rows; further columns
are ignored.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package, stage, unstage
from cinelake.llm.text import slices, utf8, word_array

#: Documents and postings of a segment (one longer document may exceed these).
SEGMENT_DOCS, SEGMENT_POSTINGS = 1 << 13, 1 << 20
#: Most bytes of item terms that tasks hold while they index, and search, at a time.
VOCABULARY_BYTES, BLOCK_BYTES = 64 << 20, 16 << 20
#: Intervals split in one step.
BATCH = 64

#: Bytes of terms: A-Z lower-cased, all but ASCII letters, digits and what lies beyond ASCII a space.
FOLD = np.full(256, 0x20, np.uint8)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    FOLD[_lo : _hi + 1] = np.arange(_lo, _hi + 1)
FOLD[0x41:0x5B] += 0x20
TERM = r"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

_SEGMENT = (
    "n_docs long, n_terms long, doc_ids array<bigint>, lengths array<bigint>, "
    "terms array<string>, sizes array<int>, places array<int>, counts array<int>"
)


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, distinct."""
    lower = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), lower.alias("text"))
    return rows.select("item_id", F.explode(F.expr(f"regexp_extract_all(text, '{TERM}', 0)")).alias("term")).distinct()


class Collector:
    """Postings of the documents of one task until they fill a segment."""

    def __init__(self):
        self.parts, self.ids, self.docs, self.postings = [], [], 0, 0
        self.n_docs = self.n_terms = 0

    def add(self, ids: pa.Array, words: pa.Array, counts: np.ndarray, wanted: pa.Array | None) -> None:
        coded = words.dictionary_encode()
        terms, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(counts)), counts)
        if wanted is not None and len(terms):
            keep = pc.is_in(terms, value_set=wanted).to_numpy(zero_copy_only=False)[code]
            code, doc = code[keep], doc[keep]
        key, tf = np.unique(doc * max(1, len(terms)) + code, return_counts=True)
        doc, code = np.divmod(key, max(1, len(terms)))
        held, doc = np.unique(doc, return_inverse=True)
        used, code = np.unique(code, return_inverse=True)
        self.n_docs += int(np.count_nonzero(counts))
        self.n_terms += int(counts.sum())
        self.parts.append((terms.take(pa.array(used)), code, doc + self.docs, tf, counts[held]))
        self.ids.append(ids.take(pa.array(held)))
        self.docs += len(held)
        self.postings += len(tf)

    def row(self) -> dict:
        """One segment, and a fresh start."""
        terms = pa.concat_arrays([p[0] for p in self.parts]).dictionary_encode()
        unified = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        shift = np.cumsum([0] + [len(p[0]) for p in self.parts])
        code = unified[np.concatenate([p[1] + s for p, s in zip(self.parts, shift, strict=False)])]
        doc, tf, lengths = (np.concatenate([p[k] for p in self.parts]) for k in (2, 3, 4))
        # Documents by their most frequent term, then by length.
        order = np.lexsort((code, -tf, doc))
        chief = code[order][np.unique(doc[order], return_index=True)[1]]
        docs = np.lexsort((lengths, chief))
        place = np.empty(len(docs), np.int64)
        place[docs] = np.arange(len(docs))
        order = np.lexsort((place[doc], code))
        out = {
            "n_docs": self.n_docs,
            "n_terms": self.n_terms,
            "doc_ids": pa.concat_arrays(self.ids).take(pa.array(docs)),
            "lengths": lengths[docs],
            "terms": terms.dictionary.cast(pa.string()),
            "sizes": np.bincount(code, minlength=len(terms.dictionary)),
            "places": place[doc][order],
            "counts": tf[order],
        }
        self.__init__()
        return out


def _index(wanted):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(pickle.loads(wanted.value), pa.large_binary()) if wanted is not None else None
        types = {"n_docs": pa.int64(), "n_terms": pa.int64()}
        lists = {"doc_ids": pa.int64(), "lengths": pa.int64(), "terms": pa.string(), "sizes": pa.int32(), "places": pa.int32(), "counts": pa.int32()}

        def segment() -> pa.RecordBatch:
            row = here.row()
            columns = [pa.array([row[k]], t) for k, t in types.items()]
            for name, kind in lists.items():
                values = row[name] if isinstance(row[name], pa.Array) else pa.array(row[name].astype(kind.to_pandas_dtype()))
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            return pa.RecordBatch.from_arrays(columns, [*types, *lists])

        here = Collector()
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                words, counts = word_array(FOLD[data[offsets[a] : offsets[b]]], offsets[a : b + 1])
                here.add(batch.column("doc_id").slice(a, b - a), words, counts, vocabulary)
                if here.docs >= SEGMENT_DOCS or here.postings >= SEGMENT_POSTINGS:
                    yield segment()
        if here.n_docs:
            yield segment()

    return index


class Segment:
    """Posting lists of one segment for the terms of ``weights``, with a sparse
    table of the places of greatest impact."""

    def __init__(self, row: dict, weights: dict[str, int], n: int, total: int):
        terms, sizes = row["terms"], row["sizes"]
        known = np.array([t in weights for t in terms], bool)
        held = np.repeat(known, sizes)
        self.doc_ids, self.place = row["doc_ids"], row["places"][held]
        sizes = sizes[known].astype(np.int64)
        self.lists = {t: k for k, t in enumerate(t for t, w in zip(terms, known, strict=True) if w)}
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        tf = row["counts"][held].astype(np.int64)
        m = (100 - 50 + (50 * row["lengths"] * n) // max(1, total))[self.place]
        weight = np.array([weights[t] for t in self.lists], np.int64)
        # One posting more, of no impact: the peak of empty intervals.
        self.size = len(tf) + 1
        self.impact = np.append(np.repeat(weight, sizes) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m)), 0)
        longest = int(sizes.max(initial=0))
        levels = [np.arange(self.size, dtype=np.int32)]
        while 2 << (len(levels) - 1) <= longest:
            step, level = 1 << (len(levels) - 1), levels[-1].copy()
            left, right = level[:-step], level[step:]
            level[:-step] = np.where(self.impact[left] >= self.impact[right], left, right)
            levels.append(level)
        self.table = np.concatenate(levels)
        self.level = np.frexp(np.maximum(1, np.arange(longest + 1)))[1].astype(np.int64) - 1

    def peaks(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and value of the greatest impact in each ``[a, b)``; value 0 if empty."""
        level, empty = self.level[b - a], a == b
        a, b = np.where(empty, self.size - 1, a), np.where(empty, self.size, b)
        row = level * self.size
        one, two = self.table[row + a], self.table[row + b - (1 << level)]
        x, y = self.impact[one], self.impact[two]
        return np.where(x >= y, one, two), np.maximum(x, y)

    def search(self, terms: list[str], best: "Best") -> int:
        """Offer the documents that may be among the best; how many were scored."""
        lists = np.array([self.lists[t] for t in terms if t in self.lists], np.int64)
        if not len(lists):
            return 0
        a, b = self.starts[lists][None, :], self.ends[lists][None, :]
        place, value = self.peaks(a, b)
        bound, scored = value.sum(axis=1), 0
        if bound[0] < max(1, best.least):
            return 0
        # How many documents of each list lie before each document of the segment.
        before = np.zeros((len(self.doc_ids) + 1, len(lists)), np.int32)
        for k, (lo, hi) in enumerate(zip(a[0].tolist(), b[0].tolist(), strict=True)):
            before[self.place[lo:hi] + 1, k] = 1
        before = np.cumsum(before, axis=0, dtype=np.int32) + a.astype(np.int32)
        while True:
            # A bound equal to the last one's score may hide a smaller doc_id.
            alive = bound >= max(1, best.least)
            if not alive.all():
                a, b, place, value, bound = a[alive], b[alive], place[alive], value[alive], bound[alive]
            if not len(bound):
                return scored
            if len(bound) > BATCH:
                turn = np.argpartition(-bound, BATCH)
                now, later = turn[:BATCH], turn[BATCH:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            peak = place[now, value[now].argmax(axis=1)]
            doc = self.place[peak]
            at, behind = before[doc], before[doc + 1]
            best.offer((self.impact[at] * (behind > at)).sum(axis=1), doc, self.doc_ids)
            scored += len(now)
            halves_a, halves_b = np.concatenate([a[now], behind]), np.concatenate([at, b[now]])
            half_place, half_value = self.peaks(halves_a, halves_b)
            half_bound = half_value.sum(axis=1)
            use = half_bound >= max(1, best.least)
            a, b = np.concatenate([a[later], halves_a[use]]), np.concatenate([b[later], halves_b[use]])
            place, value = np.concatenate([place[later], half_place[use]]), np.concatenate([value[later], half_value[use]])
            bound = np.concatenate([bound[later], half_bound[use]])


class Best:
    """An item's ``k`` best documents so far: by score, then smaller ``doc_id``,
    null ids last."""

    def __init__(self, k: int):
        self.k, self.least = k, 0
        self.score, self.id, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, score: np.ndarray, doc: np.ndarray, doc_ids: pa.Array) -> None:
        use = score >= max(1, self.least)
        if not use.any():
            return
        ids = doc_ids.take(pa.array(doc[use]))
        self.score = np.concatenate([self.score, score[use]])
        self.id = np.concatenate([self.id, ids.fill_null(0).to_numpy(zero_copy_only=False)])
        self.null = np.concatenate([self.null, ids.is_null().to_numpy(zero_copy_only=False)])
        order = np.lexsort((self.id, self.null, -self.score))[: self.k]
        self.score, self.id, self.null = self.score[order], self.id[order], self.null[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


def _read(batch: pa.RecordBatch, i: int) -> dict:
    row = {k: batch.column(k)[i].values for k in ("doc_ids", "lengths", "terms", "sizes", "places", "counts")}
    out = {k: v.to_numpy(zero_copy_only=False) for k, v in row.items() if k not in ("doc_ids", "terms")}
    return out | {"doc_ids": row["doc_ids"], "terms": row["terms"].to_pylist()}


def _search(block, n: int, total: int, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = pickle.loads(block.value)
        best = [Best(k) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                segment = Segment(_read(batch, i), weights, n, total)
                for (_, terms), top in zip(items, best, strict=True):
                    segment.search(terms, top)
        for (item, _), top in zip(items, best, strict=True):
            if len(top.score):
                ids = pa.array(top.id, pa.int64(), mask=top.null)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(ids), pa.int64()), ids, pa.array(top.score)], ["item_id", "doc_id", "score"]
                )

    return search


def _blocks(spark: SparkSession, terms: DataFrame, found: DataFrame, n: int) -> Iterator[tuple]:
    """The items with their terms, and the weight of each term that a document
    holds, in blocks of bounded size."""
    # Matched by the terms' own bytes, so that the session's collation is no matter.
    rows = terms.join(found, "term")
    size = rows.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES)
    for k in range(blocks):
        items, weights = {}, {}
        mine = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        for r in mine.orderBy("item_id", "term").toLocalIterator():
            items.setdefault(r.item_id, []).append(r.term)
            weights[r.term] = math.floor(1000 * math.log((2 * n + 2) / (2 * r.df + 1)))
        if items:
            yield list(items.items()), weights


def search_documents(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of greatest score
    above 0 for each item, equal scores by ascending ``doc_id``."""
    spark = docs.sparkSession
    ship_package(spark)
    context = spark.sparkContext
    terms = stage(item_terms(items), "item_terms")
    words = terms.select("term").distinct()
    size = words.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    wanted = None
    if size <= VOCABULARY_BYTES:  # else every term is indexed
        wanted = context.broadcast(pickle.dumps([r.term.encode() for r in words.collect()]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = stage(texts.mapInArrow(_index(wanted), _SEGMENT), "posting_lists")
    n, total = (v or 0 for v in index.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    lists = index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("l"))
    found = lists.groupBy(F.col("l.terms").alias("term")).agg(F.sum("l.sizes").alias("df"))
    parts = [spark.createDataFrame([], "item_id long, doc_id long, score long")]
    for block in _blocks(spark, terms, found, n):
        shared = context.broadcast(pickle.dumps(block))
        parts.append(index.mapInArrow(_search(shared, n, total, k), "item_id long, doc_id long, score long"))
    ranked = parts[0]
    for part in parts[1:]:
        ranked = ranked.unionAll(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    unstage(terms)
    return ranked.select("item_id", "rank", "doc_id", "score")
