"""Connected components of an edge table, by alternating star contractions.

Edges stay distributed; nothing is collected. Each round is written to the
shared folder, so a lost executor costs one round at most. Large-star joins
every neighbour above a vertex to the smallest one it knows, small-star the
rest; hot vertices are pre-aggregated (``min`` has a partial form) and the
join back is an equi-join whose large partitions adaptive execution splits: ``least``
has one row per vertex, so a join gives a row per edge at most.

Before the first round every task reduces the edges it reads to a spanning forest,
TASK_EDGES at a time: what many shared keys say of the same vertices becomes one
edge per vertex. Once that many edges are left, one task finishes them; the bound
does not grow with the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package, stage, unstage

#: Edges that a task holds at a time.
TASK_EDGES = 1 << 18


def spanning_forest(u: np.ndarray, v: np.ndarray, roots: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of every node but the roots (or of these too), root the smallest
    node of its component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    up = np.arange(len(nodes))
    while True:
        p, q = up[a], up[b]
        apart = p != q
        if not apart.any():
            break
        a, b, p, q = a[apart], b[apart], p[apart], q[apart]
        # Of two roots the larger is hung below the smaller one.
        np.minimum.at(up, np.maximum(p, q), np.minimum(p, q))
        while True:
            above = up[up]
            if (above == up).all():
                break
            up = above
    below = np.full(len(nodes), roots) | (up != np.arange(len(nodes)))
    return nodes[below], nodes[up[below]]


def _forests(most: int, roots: bool):
    """Rows (u, v) → the spanning forest of at least ``most`` of them at a time, or
    of all that the task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest(held: list[tuple]) -> pa.RecordBatch:
            pair = spanning_forest(*(np.concatenate([h[k] for h in held]) for k in (0, 1)), roots)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in pair], ["u", "v"])

        held, rows = [], 0
        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v")))
            rows += batch.num_rows
            if rows > most:
                yield forest(held)
                held, rows = [], 0
        if held:
            yield forest(held)

    return run


def _spanned(edges: DataFrame, most: int, roots: bool = False) -> DataFrame:
    return edges.select("u", "v").mapInArrow(_forests(most, roots), "u long, v long")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u")
    return linked.select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e")).select(
        F.col("e.v").alias("u"), F.col("e.m").alias("v")
    )


def components(edges: DataFrame, most_rounds: int = 60, most: int = TASK_EDGES) -> DataFrame:
    """``(u, v)`` long edges → staged ``(node, root)``, root the smallest node of
    the component; only nodes that occur in an edge between two different nodes.
    No edges give no rows; loops and repeated edges change nothing."""
    ship_package(edges.sparkSession)

    def measure(df: DataFrame) -> tuple:
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = stage(_spanned(edges.where("u <> v"), most), "edges")
    seen = measure(now)
    for _ in range(most_rounds):
        if seen[0] <= most:  # one task holds them all
            last = _spanned(now.coalesce(1), most, roots=True)
            out = stage(last.select(F.col("u").alias("node"), F.col("v").alias("root")), "components")
            unstage(now)
            return out
        new = stage(_small_star(_large_star(now).distinct()).where("u <> v").distinct(), "edges")
        unstage(now)
        now, before, seen = new, seen, measure(new)
        if before == seen:
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = stage(roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()), "components")
    unstage(now)
    return out
