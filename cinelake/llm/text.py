"""Array kernels over Arrow text columns: words, word hashes, shingle sets.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; UTF-8
continuation bytes are never separators, so working on bytes equals working
on code points. Null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; a single longer text makes a longer slice.
SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32  # A-Z hash as a-z


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit words."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; nulls become empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes, or one longer row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the index of its first word
    (one entry more than rows)."""
    offsets = offsets - offsets[0]
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    head, tail = offsets[:-1][filled], offsets[1:][filled] - 1
    starts[head] = inside[head]
    ends[tail] = inside[tail]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets)


def word_array(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The words of a slice of texts as one binary array, and each text's count."""
    starts, ends, first = word_bounds(data, offsets)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), np.diff(first)


def word_counts(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    data, offsets = utf8(column)
    out = np.zeros(len(offsets) - 1, np.int64)
    for a, b in slices(offsets):
        _, _, first = word_bounds(data[offsets[a] : offsets[b]], offsets[a : b + 1])
        out[a:b] = np.diff(first)
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word with A-Z lower-cased.

    A word is read in lanes of eight bytes; every lane is mixed with its place
    before the lanes are summed, so that no algebra over the bytes (as of a
    polynomial) makes different words meet.
    """
    if not len(starts):
        return np.empty(0, np.uint64)
    length = ends - starts
    lanes = (length + 7) >> 3
    first = np.cumsum(lanes) - lanes
    word = np.repeat(np.arange(len(starts)), lanes)
    at = 8 * (np.arange(len(word)) - first[word])
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = _LOWER[data]
    every = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,))
    lane = every[starts[word] + at]
    left = length[word] - at
    short = left < 8
    lane[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
    place = mix(at.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return mix(np.add.reduceat(mix(lane + place), first) + length.astype(np.uint64))


def _fold(hashes: list[np.ndarray], size: int) -> np.ndarray:
    out = np.full(len(hashes[0]), size, np.uint64)
    for h in hashes:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + h)
    return out


def shingle_sets(column: pa.Array | pa.ChunkedArray, size: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct 64-bit hashes of its shingles.

    A text of fewer than ``size`` words has its whole sequence as one shingle;
    a text without words, or null, has none.
    """
    data, offsets = utf8(column)
    for a, b in slices(offsets):
        part = data[offsets[a] : offsets[b]]
        starts, ends, first = word_bounds(part, offsets[a : b + 1])
        words = word_hashes(part, starts, ends)
        n = max(0, len(words) - size + 1)
        rolled = _fold([words[k : k + n] for k in range(size)], size) if n else words[:0]
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if hi - lo >= size:
                yield np.unique(rolled[lo : hi - size + 1])
            elif hi > lo:
                yield _fold([words[k : k + 1] for k in range(lo, hi)], hi - lo)
            else:
                yield words[:0]


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, as two signed longs; independent of order."""
    a = mix(tokens ^ np.uint64(0x243F6A8885A308D3)).sum(dtype=np.uint64)
    b = mix(tokens ^ np.uint64(0x13198A2E03707344)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))
