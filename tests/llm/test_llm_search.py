"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from cinelake.llm import interval_search
from tests.llm.helpers import documents, lower

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, items, k):
    docs = [(i, Counter(TERM.findall(lower(t)))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(x[2] for x in docs)
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(TERM.findall(lower(text)))
    out = []
    for item, words in terms.items():
        df = {t: sum(t in c for _, c, _ in docs) for t in words}
        found = []
        for i, c, size in docs:
            m = 100 - 50 + (50 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in words if c[t])
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"{w}{i}" for i in range(40) for w in ("Ab", "é", "Zx9", "日本")]
    texts = [" ".join(rng.choices(words, weights=[1 / (1 + k) for k in range(len(words))], k=rng.choice([1, 4, 30, 200]))) for _ in range(n)]
    texts += [None, "", "-- !!", "\x7f", texts[0], texts[0].upper(), texts[1] + "," + texts[1], "ab0 " * 9000]
    rows = [(3 * i, t) for i, t in enumerate(texts)] + [(9, texts[4]), (9, texts[4]), (None, texts[5]), (None, texts[6])]
    items = [(j, ". ".join(rng.choices(words, k=rng.choice([1, 3, 30])))) for j in range(25)]
    return rows, items + [(50, texts[0]), (51, None), (52, "nowhere"), (53, ""), (7, "Ab1 ab2"), (None, "ab3")]


@pytest.mark.parametrize("docs_each, batch, block, vocabulary", [(8192, 64, 1 << 24, 1 << 26), (7, 1, 500, 1 << 26), (40, 3, 1 << 24, 0)])
def test_ranks_equal_brute_force(spark, monkeypatch, docs_each, batch, block, vocabulary):
    for name, value in (("SEGMENT_DOCS", docs_each), ("BATCH", batch), ("BLOCK_BYTES", block), ("VOCABULARY_BYTES", vocabulary)):
        monkeypatch.setattr(interval_search, name, value)
    rows, items = corpus(docs_each)
    table = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in items], "item_id long, text string, rank int, term string, df long")
    got = interval_search.search_documents(documents(spark, rows), table, k=5).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, items, 5)


def test_empty_tables(spark):
    docs, items = documents(spark, [(1, "a b"), (2, None)]), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r)[:3] for r in interval_search.search_documents(docs, items).collect()] == [(1, 1, 1)]
    assert interval_search.search_documents(docs.where("doc_id > 5"), items).count() == 0
    assert interval_search.search_documents(docs, items.where("item_id > 5")).count() == 0
    assert interval_search.search_documents(docs.where("doc_id = 2"), items).count() == 0


def test_the_search_leaves_most_documents_unscored():
    import numpy as np
    import pyarrow as pa

    rng, n = np.random.default_rng(2), 2000
    here = interval_search.Collector()
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, 60)) for _ in range(n)]
    words = pa.array([w.encode() for t in texts for w in t.split()], pa.large_binary())
    here.add(pa.array(range(n)), words, np.full(n, 60), None)
    row = {k: v if isinstance(v, pa.Array) else np.asarray(v) for k, v in here.row().items()}
    weights = {t: 1000 for t in row["terms"].to_pylist()}
    segment = interval_search.Segment(row | {"terms": row["terms"].to_pylist()}, weights, n, 60 * n)
    best = interval_search.Best(5)
    assert segment.search(["w1", "w2", "w3"], best) < n / 4 and len(best.score) == 5
