"""BPE encoding by a priority queue of merge ranks over a doubly linked symbol list.

A text is cut at the added special strings, normalised, and split into pieces
by the vocabulary file's own pattern. A piece starts as a linked list of
symbols; a heap holds (rank, position) of every adjacent pair that merges. The
lowest rank merges first, leftmost at equal rank; an entry whose symbols have
changed meanwhile is stale and skipped. Pieces recur, so each Python worker
keeps a bounded memo of pieces already encoded. Decoding concatenates
vocabulary strings, joined by one space where the file names no decoder.

Defined results: null text is empty text and gives no ids and an empty decoded
text; texts of any length are encoded whole, in time n log n per piece; tables
without rows give no rows; only ``doc_id`` and ``text`` are read, so other
columns may have any names; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package
from cinelake.llm.text import slices, utf8

#: Pieces that a worker remembers in each of two generations, and the longest
#: that it remembers.
MEMO_PIECES, MEMO_LENGTH = 250_000, 64

_FIRST, _SECOND = itemgetter(0), itemgetter(1)

SCHEMA = "doc_id long, n_tokens long, ids array<int>, decoded string"


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the
    next unused code point from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class _Memo(dict):
    """Values by piece, made on first use. When full, it becomes the older
    generation, from which pieces still in use are taken over."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, piece: str):
        value = self.older.get(piece)
        if value is None:
            value = self.make(piece)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = value
        return value


class WordBpe:
    """Encoder of a byte-level BPE vocabulary file with word ends."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or model["byte_fallback"] or model["ignore_merges"] or spec["decoder"]:
            raise ValueError("not a vocabulary file of this kind")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.strings = {i: s for s, i in self.vocab.items()}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.bytes = byte_alphabet()
        self.first = [self.vocab[c] for c in self.bytes]
        self.special = {}
        for t in spec["added_tokens"]:
            if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]:
                raise ValueError("added tokens of this kind are not supported")
            self.special[t["content"]] = t["id"]
            self.strings[t["id"]] = t["content"]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        steps = {s["type"]: s for s in (spec["normalizer"] or {}).get("normalizers", [])}
        if set(steps) - {"NFC", "Replace", "Lowercase"}:
            raise ValueError("normaliser steps of this kind are not supported")
        self.nfc, self.lower = "NFC" in steps, "Lowercase" in steps
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        # White space is a separator for the pattern, so collapsing it first changes no piece.
        self.pieces = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")).findall
        self.known = _Memo(self._encoded)

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece."""
        raw = piece.encode()
        symbol = [self.first[b] for b in raw]
        symbol[-1] = self.vocab[self.bytes[raw[-1]] + self.suffix]
        n, ranks, push, pop = len(symbol), self.ranks.get, heapq.heappush, heapq.heappop
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            found = ranks((symbol[i], symbol[i + 1]))
            if found:
                heap.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = pop(heap)
            j = after[i]
            if symbol[i] != a or j < 0 or symbol[j] != b:
                continue  # stale: one side has merged meanwhile
            symbol[i], symbol[j] = made, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                found = ranks((made, symbol[k]))
                if found:
                    push(heap, (found[0], i, made, symbol[k], found[1]))
            h = before[i]
            if h >= 0:
                found = ranks((symbol[h], made))
                if found:
                    push(heap, (found[0], h, symbol[h], made, found[1]))
        return [s for s in symbol if s >= 0]

    def _encoded(self, piece: str) -> tuple[bytes, str]:
        """Ids of a piece as 32-bit integers, and their strings."""
        ids = self.merge(piece)
        return array("i", ids).tobytes(), self.decode(ids)

    def normalise(self, text: str) -> str:
        if self.nfc and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:
            text = text.replace("Σ", "σ").lower()  # each character by itself: no final sigma
        return text

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """(ids, decoded text)."""
        ids, words = [], []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                ids.append(array("i", [self.special[part]]).tobytes())
                words.append(part)
            elif part:
                found = list(map(self.known.__getitem__, self.pieces(self.normalise(part))))
                ids.extend(map(_FIRST, found))
                words.extend(map(_SECOND, found))
        return np.frombuffer(b"".join(ids), np.int32), " ".join(words)

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[i] for i in ids)


@lru_cache(maxsize=4)
def _encoder(digest: str, spec: bytes) -> WordBpe:
    return WordBpe(json.loads(spec))


def encode_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` per row. The vocabulary file is read
    on the driver and broadcast (a few MB, whatever the input)."""
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_path, "rb") as f:
        raw = f.read()
    digest, shared = hashlib.sha256(raw).hexdigest(), spark.sparkContext.broadcast(raw)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(digest, shared.value)
        for batch in batches:
            _, offsets = utf8(batch.column("text"))
            for a, b in slices(offsets):
                done = [encoder.encode(t or "") for t in batch.column("text").slice(a, b - a).to_pylist()]
                counts = np.array([len(ids) for ids, _ in done], np.int64)
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([ids for ids, _ in done]), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts), ids, pa.array([t for _, t in done], pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, SCHEMA)


def with_digests(encoded: DataFrame) -> DataFrame:
    """SHA-256 of the ids (decimal, joined by one space) and of the decoded text."""
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
