"""Signature trees against brute force, routing and pruning without loss."""

import numpy as np
import pyarrow as pa
import pytest

from cinelake.llm import signature_tree as trees
from cinelake.llm.graph import _forests, components, spanning_forest
from cinelake.llm.text import shingle_sets, word_counts
from tests.llm.helpers import WORD, copies, documents, jaccard_components, shingles


def _got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("size,percent,block", [(3, 90, 256), (5, 80, 8)])
def test_components_equal_brute_force(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(trees, "BLOCK", block)
    rows = copies(size + block)
    got = _got(trees.jaccard_components(documents(spark, rows), size, percent))
    assert got == jaccard_components(rows, size, percent)


def test_empty_table_and_texts_without_words(spark):
    empty = documents(spark, [(1, None)]).where("doc_id < 0")
    assert trees.jaccard_components(empty, 3, 90).count() == 0
    rows = [(5, None), (4, ""), (9, " \t"), (2, "\x0b")]
    assert _got(trees.jaccard_components(documents(spark, rows), 3, 90)) == {i: (0, i) for i, _ in rows}


def test_rows_without_an_id_or_with_a_repeated_one(spark):
    long = " ".join(f"w{i}" for i in range(100))
    near = long + " end"
    rows = [(None, near), (7, long), (5, "some other text"), (5, long), (None, "none has an id"), (7, long), (3, None), (None, "")]
    found = trees.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = [(None, 99, 5), (7, 98, 5), (5, 1, 5), (5, 98, 5), (None, 2, None), (7, 98, 5), (3, 0, 3), (None, 0, None)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("held", [1, 40])
def test_small_batches_of_keys_and_large_families(spark, monkeypatch, held):
    monkeypatch.setattr(trees, "BLOCK", 8)
    monkeypatch.setattr(trees, "HELD_KEYS", held)
    line = " ".join(f"common{i}" for i in range(20))
    rows = [(i, f"{t or ''} {line}") for i, t in copies(held, groups=12)]
    got = _got(trees.jaccard_components(documents(spark, rows), 5, 80))
    assert got == jaccard_components(rows, 5, 80)


def test_very_long_texts(spark):
    words = [f"w{i % 7919}x{i % 31}" for i in range(150_000)]
    rows = [(2, " ".join(words)), (1, " ".join([*words[:-500], "other", "end"])), (3, "x" * 1_000_000), (4, " ".join(words[:1000]))]
    got = _got(trees.jaccard_components(documents(spark, rows), 3, 90))
    assert got == jaccard_components(rows, 3, 90)
    assert got[2][1] == 1


def test_sets_are_those_of_the_words():
    texts = [t for _, t in copies(3)] + ["é É É É", "a" * 5000 + " b c", "\x1ca b\x85c d"]
    column = pa.array(texts)
    assert word_counts(column).tolist() == [len(WORD.findall(t or "")) for t in texts]
    for size in (3, 5):
        ids = {}
        for text, tokens in zip(texts, shingle_sets(column, size), strict=True):
            want = shingles(text, size)
            assert len(tokens) == len(want) and (np.diff(tokens.astype(object)) > 0).all()
            key = frozenset(want)
            assert ids.setdefault(key, tuple(tokens.tolist())) == tuple(tokens.tolist())
        assert len(set(ids.values())) == len(ids)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    found = 0
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop, add = rng.integers(0, max(1, n // 8) + 1, 2)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        if len(b) and trees.linked(a, b, percent):
            found += 1
            assert np.intersect1d(trees.routing_keys(a, percent), trees.routing_keys(b, percent)).size
    assert found > 300


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_rare_token(percent):
    rng = np.random.default_rng(percent)
    counts, found = rng.integers(0, 50, trees.SLOTS), 0
    for _ in range(1000):
        n = int(rng.integers(1, 300))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        drop, add = rng.integers(0, max(1, n // 6) + 1, 2)
        b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2**63, add, dtype=np.uint64)]))
        if len(b) and trees.linked(a, b, percent):
            found += 1
            assert np.intersect1d(trees.rare_tokens(a, counts, percent), trees.rare_tokens(b, counts, percent)).size
    assert found > 200


@pytest.mark.parametrize("batch", [1, 3, 1000])
def test_tokens_held_by_several_nodes_across_batches(batch):
    rng = np.random.default_rng(batch)
    rows = sorted(zip(rng.integers(-9, 9, 60).tolist(), rng.integers(-5, 5, 60).tolist(), strict=True))
    names = ["token", "node", "n", "room"]
    cut = [rows[i : i + batch] for i in range(0, len(rows), batch)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*((t, v, v + 10, 2) for t, v in part), strict=True)], names) for part in cut]
    got = [r for out in trees._held_by_several(80)(iter(batches)) for r in out.to_pylist()]
    nodes = {t: {v for u, v in rows if u == t} for t, _ in rows}
    want = [(t, v, len(nodes[t])) for t, v in sorted(set(rows)) if len(nodes[t]) > 1]
    assert [(r["token"], r["node"], r["c"]) for r in got] == want
    assert all(range(r["low"], r["high"] + 1) == trees.bands(r["node"] + 10, 80) and r["room"] == 2 for r in got)
    assert not [r for out in trees._held_by_several(80)(iter([])) for r in out.to_pylist()]


@pytest.mark.parametrize("spare", [0, 3])
def test_frequent_tokens_come_last_without_loss(spark, monkeypatch, spare):
    monkeypatch.setattr(trees, "SPARE", spare)
    line = " ".join(f"common{i}" for i in range(20))
    rows = [(i, f"{t or ''} {line}") for i, t in copies(spare, groups=12)]
    assert _got(trees.jaccard_components(documents(spark, rows), 5, 80)) == jaccard_components(rows, 5, 80)


def test_words_of_algebraic_structure_hash_apart():
    word = "a"
    while len(word) < 8192:
        word += word.translate(str.maketrans("ab", "ba"))
        other = word.translate(str.maketrans("ab", "ba"))
        column = pa.array([f"{word} {other} x", f"{other} {word} x", word, other, word.upper(), word + "a", "a" * len(word), "b" * len(word)])
        tokens = [t.tolist() for t in shingle_sets(column, 1)]
        assert tokens[2] == tokens[4] and tokens[0] == tokens[1] and len(tokens[0]) == 3
        assert len({t[0] for t in tokens[2:]}) == 5 and len(tokens[2]) == 1


@pytest.mark.parametrize("percent", [80, 90])
def test_traversal_loses_no_link(percent):
    sets = [s for s in shingle_sets(pa.array([t for _, t in copies(percent, 15)]), 3) if len(s)]
    sets = list({tuple(s.tolist()): s for s in sets}.values())
    want = {(i, j) for i in range(len(sets)) for j in range(i) if trees.linked(sets[i], sets[j], percent)}
    tree = trees.SignatureTree(sets, trees.bitmap_bits(sets))
    got = [(max(p), min(p)) for p in trees.traverse(tree, tree, percent)]
    assert len(got) == len(set(got)) and want <= set(got)
    assert len(got) < len(sets) * (len(sets) - 1) / 8  # most pairs are pruned
    half = len(sets) // 2
    x, y = (trees.SignatureTree(part, 1024) for part in (sets[:half], sets[half:]))
    across = {(half + b, a) for a, b in trees.traverse(x, y, percent)}
    assert {(i, j) for i, j in want if j < half <= i} <= across


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (139, 5)]
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 10 for i in range(10, 61)}, **{i: 5 for i in [5, *range(100, 140)]}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("most", [0, 7, 1000])
def test_components_with_more_edges_than_a_task_holds(spark, most):
    rng = np.random.default_rng(most)
    edges = rng.integers(-60, 60, (90, 2)).tolist() + [(1000 + i, 1001 + i) for i in range(30)] + [(5000, i) for i in range(4900, 4960)]
    rows = components(spark.createDataFrame(edges, "u long, v long").repartition(5), most=most).collect()
    root = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in root:
        for u, v in edges:
            if u != v:
                root[u] = root[v] = min(root[u], root[v])
    assert sorted((r.node, r.root) for r in rows) == sorted(root.items())


def test_many_keys_of_the_same_nodes_leave_an_edge_per_node():
    # 200 copies that meet under each of 50 keys, at another smallest node.
    edges = np.array([(i, k) for k in range(50) for i in range(k + 1, 200)], np.int64)
    u, v = spanning_forest(edges[:, 0], edges[:, 1])
    assert u.tolist() == list(range(1, 200)) and not v.any()
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in part.T], ["u", "v"]) for part in np.array_split(edges, 9)]
    assert sum(b.num_rows for b in _forests(1 << 18, False)(iter(batches))) == 199
    assert not spanning_forest(edges[:0, 0], edges[:0, 1])[0].size


@pytest.mark.parametrize("bits", [6, 48])
def test_tokens_that_meet_in_fewer_bits_lose_no_link(spark, monkeypatch, bits):
    monkeypatch.setattr(trees, "TOKEN_BITS", bits)
    rows = copies(bits, groups=12)
    assert _got(trees.jaccard_components(documents(spark, rows), 5, 80)) == jaccard_components(rows, 5, 80)


def test_tokens_are_shuffled_in_three_numbers():
    shared = type("Shared", (), {"value": np.zeros(trees.SLOTS, np.int64).tobytes()})()
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c d e f g h", None])], ["text"])
    rows = [r for out in trees._plain_tokens(3, 80, shared, 0)(iter([batch])) for r in out.to_pylist()]
    assert len(rows) == 6 and all(list(r) == ["token", "node", "sizes"] and 0 <= r["token"] < 1 << 48 for r in rows)
    assert {(r["sizes"] >> 32, r["sizes"] & 0xFFFFFFFF) for r in rows} == {(6, 6 - trees.prefix_length(6, 80))}
