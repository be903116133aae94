"""Runs by recompression against a direct search for every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from cinelake.llm import recompression
from tests.llm.helpers import WORD, documents


def brute_runs(words, least=6, repeats=4):
    """[(start, length, period)] by start and period."""
    out = {}
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                out.setdefault((i, j + q - i), q)
            i = j if j > i else i + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def want(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def texts(seed):
    rng = random.Random(seed)
    out = [None, "", " \n\t", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x " * 5000, "é ü " * 30]
    for _ in range(150):
        names = [f"w{i}é" for i in range(rng.choice([1, 2, 3, 60]))]
        words = [rng.choice(names) for _ in range(rng.choice([3, 12, 60, 300]))]
        for _ in range(rng.choice([0, 1, 3])):
            at, p = rng.randrange(len(words)), rng.randint(1, 1 + len(words) // 4)
            for i in range(at, min(len(words), at + p * rng.randint(2, 9))):
                words[i] = words[at + (i - at) % p]
        out.append("".join(w + rng.choice([" ", "\n", "  \r", "\x0b"]) for w in words))
    return out


def test_rows_equal_brute_force(spark):
    rows = list(enumerate(texts(1))) + [(None, "a a a a a a a"), (3, "b b b b b b b"), (-4, "c " * 9)]
    got = recompression.run_rows(recompression.find_runs(recompression.plant_repeats(documents(spark, rows)))).collect()
    assert sorted(map(tuple, got), key=str) == sorted((want(i, t) for i, t in rows), key=str)
    docs = documents(spark, rows)
    assert recompression.run_rows(recompression.find_runs(docs.where("doc_id > 9999"))).count() == 0


@pytest.mark.parametrize("least, repeats, block", [(6, 4, 64), (2, 2, 1 << 20), (3, 3, 500)])
def test_any_least_length_and_repeats(monkeypatch, least, repeats, block):
    monkeypatch.setattr(recompression, "CANDIDATES", block)
    rng = random.Random(least)
    docs = [[rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.choice([0, 1, 7, 40]))] for _ in range(80)]
    flat = np.array([w for d in docs for w in d], np.int64)
    d, s, n, q = recompression.runs_of(flat, np.array([len(w) for w in docs]), least, repeats)
    got = [[] for _ in docs]
    for i, *run in zip(d.tolist(), s.tolist(), n.tolist(), q.tolist()):
        got[i].append(tuple(run))
    assert got == [brute_runs(w, least, repeats) for w in docs]


def test_extensions_are_longest_common_ones():
    rng = np.random.default_rng(3)
    words = np.concatenate([np.tile(rng.integers(0, 3, 7), 40), rng.integers(0, 2, 300), np.zeros(200, np.int64)])
    s = np.concatenate([[-1], words, [-2], words[:100], [-3]])
    grammar = recompression.Grammar(s)
    assert len(grammar.symbols[-1]) == 5  # a symbol for either document, and the separators
    x, y = rng.integers(0, len(s), 800), rng.integers(0, len(s), 800)
    x, y = x[x != y], y[x != y]
    for ahead in (True, False):
        for a, b, n in zip(x.tolist(), y.tolist(), grammar.extend(x, y, ahead).tolist()):
            step, k = 1 if ahead else -1, 0
            while 0 <= min(a, b) + k * step and max(a, b) + k * step < len(s) and s[a + k * step] == s[b + k * step]:
                k += 1
            assert n == k
