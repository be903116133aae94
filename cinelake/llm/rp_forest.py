"""Approximate nearest neighbours by a forest of random-projection trees.

Trees are fitted on a bounded sample of distinct vectors: a node projects on the
difference of two of its vectors and cuts at the median. Every distinct vector
is then indexed in one leaf of every tree. A query walks all trees through one
shared priority queue, nearest margins first, until it has a fixed number of
leaves. Queries and vectors meet by an equi-join of work on (tree, leaf, block),
blocks of bounded size; a task ranks each query against its block exactly on the
original vectors and passes on its best, which are merged per query.

Equal vectors are one entry with its ``k + 1`` smallest ids, which is all that a
result can hold of them, so a vector that a third of all rows share costs as
much as any other.

Defined results: a vector that is null, zero, holds null or non-finite
components, or has not the table's most frequent length (ties: the shorter)
takes no part, as a query or a candidate; fewer than ``k`` candidates give all
of them; equal distances go by the smaller id; an empty table gives no rows;
rows that repeat an id and vector count once. Other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package, stage, unstage

#: Vectors of the fitting sample, trees, sample vectors of a leaf, indexed vectors
#: of a block.
SAMPLE, TREES, LEAF, BLOCK = 50_000, 12, 256, 1024
#: Share of all leaves that a query visits, and the least number. Directions
#: without structure need a large share: with 64 nearly independent components,
#: 0.08 visits about half of the vectors for a recall above 0.9.
SHARE, LEAST_PROBES = 0.08, 24
#: Queries whose best a task holds before it passes them on.
HELD_QUERIES = 50_000
SEED = 5


class Tree:
    """Arrays by node: direction, cut, and children (a negative child is leaf ``-1 - child``)."""

    def __init__(self, vectors: np.ndarray, seed: int, leaf: int = LEAF):
        rng = np.random.default_rng(seed)
        direction, cut, kids, self.leaves = [], [], [], 0

        def grow(rows: np.ndarray) -> int:
            if len(rows) <= leaf:
                self.leaves += 1
                return -self.leaves
            a, b = rng.choice(rows, 2, replace=False)
            d = vectors[a] - vectors[b]
            length = float(np.linalg.norm(d))
            d = d / length if length else rng.normal(size=vectors.shape[1])
            side = vectors[rows] @ d
            order = np.argsort(side, kind="stable")
            half = len(rows) // 2
            node = len(cut)
            direction.append(d)
            cut.append((side[order[half - 1]] + side[order[half]]) / 2)
            kids.append(None)
            kids[node] = (grow(rows[order[:half]]), grow(rows[order[half:]]))
            return node

        self.root = grow(np.arange(len(vectors)))
        self.direction = np.array(direction, np.float32).reshape(len(cut), vectors.shape[1])
        self.cut, self.kids = np.array(cut, np.float64), np.array(kids, np.int64).reshape(len(cut), 2)

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        node = np.full(len(vectors), self.root, np.int64)
        active = np.flatnonzero(node >= 0)
        while len(active):
            at = node[active]
            right = np.einsum("ij,ij->i", vectors[active], self.direction[at]) > self.cut[at]
            node[active] = self.kids[at, right.astype(np.int64)]
            active = active[node[active] >= 0]
        return -1 - node


def probes(trees: list[Tree], q: np.ndarray, count: int) -> list[tuple[int, int]]:
    """The (tree, leaf) pairs that a query visits: one queue over all trees, ordered
    by the smallest margin by which the query lies on the other side on the way."""
    heap = [(-np.inf, k, t.root) for k, t in enumerate(trees)]
    heapq.heapify(heap)
    out: list[tuple[int, int]] = []
    while heap and len(out) < count:
        margin, k, node = heapq.heappop(heap)
        tree = trees[k]
        while node >= 0:
            side = float(tree.direction[node] @ q) - tree.cut[node]
            near, far = (1, 0) if side > 0 else (0, 1)
            heapq.heappush(heap, (max(margin, abs(side)), k, int(tree.kids[node, far])))
            node = int(tree.kids[node, near])
        out.append((k, -1 - node))
    return out


@lru_cache(maxsize=2)
def _load(raw: bytes):
    return pickle.loads(raw)


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _fit(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = _load(shared.value)
        for batch in batches:
            yield pd.DataFrame({"tree": batch["id"], "raw": [pickle.dumps(Tree(vectors, SEED + int(k))) for k in batch["id"]]})

    return run


def _index(shared):
    def run(batches):
        trees = _load(shared.value)
        for batch in batches:
            if len(batch):
                vectors = _stack(batch["v"])
                for k, tree in enumerate(trees):
                    yield pd.DataFrame({"tree": k, "leaf": tree.leaf_of(vectors), "vid": batch["vid"]})

    return run


def _walk(shared):
    def run(batches):
        trees = _load(shared.value)
        for batch in batches:
            count = max(LEAST_PROBES, int(np.ceil(SHARE * sum(t.leaves for t in trees))))
            for vid, q in zip(batch["vid"], _stack(batch["v"]) if len(batch) else (), strict=True):
                found = probes(trees, q, count)
                yield pd.DataFrame({"tree": [t for t, _ in found], "leaf": [f for _, f in found], "qid": vid})

    return run


def _rank(k: int):
    """Runs of one (tree, leaf, block), queries (``is_query``) first → each query's
    ``k + 1`` nearest distinct vectors among all runs of a task. A run's vectors
    come in pieces, so memory holds its queries, one piece and the best so far."""

    def run(batches):
        key, qids, queries, best = None, [], [], {}

        def flush() -> pd.DataFrame:
            out = [(q, v, d) for q, (vs, ds) in best.items() for v, d in zip(vs.tolist(), ds.tolist(), strict=True)]
            best.clear()
            return pd.DataFrame(out, columns=["qid", "vid", "d"])

        for batch in batches:
            if not len(batch):
                continue
            for now, part in batch.groupby(["tree", "leaf", "block"], sort=False):
                if now != key:
                    key, qids, queries = now, [], []
                asked = part["is_query"].to_numpy()
                if asked.any():
                    qids.extend(part["vid"][asked].tolist())
                    queries.extend(_stack(part["v"][asked]))
                if not qids or asked.all():
                    continue
                vids, vectors = part["vid"][~asked].to_numpy(), _stack(part["v"][~asked])
                for qid, q in zip(qids, queries, strict=True):
                    d = np.sqrt(((vectors - q) ** 2).sum(axis=1))
                    near = np.argpartition(d, k)[: k + 1] if len(d) > k + 1 else slice(None)
                    near = d <= np.max(d[near])  # ties included
                    v, d = vids[near], d[near]
                    if qid in best:
                        v, d = np.concatenate([best[qid][0], v]), np.concatenate([best[qid][1], d])
                        v, first = np.unique(v, return_index=True)
                        d = d[first]
                    top = np.lexsort((v, d))[: k + 1]
                    best[qid] = (v[top], d[top])
            if len(best) > HELD_QUERIES:
                yield flush()
        yield flush()

    return run


def nearest_neighbours(rows: DataFrame, every: int, k: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row of
    ``rows`` (``vec_id``, ``embedding``) whose id is divisible by ``every``."""
    spark = rows.sparkSession
    ship_package(spark)
    v = F.col("embedding").cast("array<double>")
    usable = rows.where("vec_id IS NOT NULL AND embedding IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = usable.where(F.coalesce(fine, F.lit(False)))
    length = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if length is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.size("v") == length.n).distinct()

    # Distinct vectors with their smallest ids; the partial limit runs before the shuffle.
    order = Window.partitionBy("v").orderBy("vec_id")
    first = usable.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= k + 1)
    entries = stage(first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.element_at("ids", 1).alias("vid"), "v", "ids"), "vectors")
    asked = usable.where(F.col("vec_id") % every == 0).join(entries.select("vid", "v"), "v").select(F.col("vec_id").alias("query_id"), F.col("vid").alias("qid"))
    asked = stage(asked, "queries")

    sample = entries.orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE).select("v").collect()  # bounded by SAMPLE
    vectors = spark.sparkContext.broadcast(pickle.dumps(np.array([r.v for r in sample], np.float64)))
    grown = spark.range(0, TREES, 1, TREES).mapInPandas(_fit(vectors), "tree long, raw binary").collect()
    forest = spark.sparkContext.broadcast(pickle.dumps([pickle.loads(r.raw) for r in sorted(grown, key=lambda r: r.tree)]))

    places = "tree long, leaf long, vid long"
    indexed = entries.select("vid", "v").mapInPandas(_index(forest), places)
    sizes = indexed.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    indexed = stage(indexed.join(sizes, ["tree", "leaf"]), "leaves")
    sizes = indexed.select("tree", "leaf", "blocks").distinct()
    queries = asked.select(F.col("qid").alias("vid")).distinct().join(entries.select("vid", "v"), "vid")
    walked = queries.mapInPandas(_walk(forest), "tree long, leaf long, qid long").join(sizes, ["tree", "leaf"])
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    visits = walked.select("tree", "leaf", blocks.alias("block"), F.col("qid").alias("vid"), F.lit(True).alias("is_query"))
    visited = visits.select("tree", "leaf", "block").distinct()
    stored = indexed.select("tree", "leaf", F.pmod(F.xxhash64("vid"), F.col("blocks")).cast("long").alias("block"), "vid", F.lit(False).alias("is_query"))
    work = visits.unionByName(stored.join(visited, ["tree", "leaf", "block"], "left_semi")).join(entries.select("vid", "v"), "vid")
    work = work.repartition("tree", "leaf", "block").sortWithinPartitions("tree", "leaf", "block", F.desc("is_query"))
    found = work.select("tree", "leaf", "block", "is_query", "vid", "v").mapInPandas(_rank(k), "qid long, vid long, d double")

    # Merge per query vector, then spread to ids: k + 1 rows serve every query of the vector.
    near = found.distinct().join(entries.select("vid", "ids"), "vid").select("qid", "d", F.explode("ids").alias("vec_id"))
    best = Window.partitionBy("qid").orderBy("d", "vec_id")
    near = near.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= k + 1).select("qid", "d", "vec_id")
    pairs = asked.join(near, "qid").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("d", "vec_id"))
    out = pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("d").alias("score"))
    out = stage(out, "neighbours")
    unstage(entries, asked, indexed)
    return out
