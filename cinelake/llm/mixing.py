"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in a shuffled order fixed by a seed, form one stream
of words cut into blocks of equal size. Slot ``t`` of the schedule takes the
point ``frac(t / golden ratio)``, which the cumulative target shares map to a
source; the rank of a slot among its source's slots names the pass and block of
the stream that it takes. A source's last block is cut where its target is met;
slots beyond its target are left out, and the few that the sequence leaves
short of it close the schedule. So every prefix of the schedule is near the
target weights and the whole meets them to the word.

Sums along a stream and ranks of slots are two-level (totals of bounded ranges,
then within a range), so a source with a third of all rows is spread over many
tasks. Only one row per source passes through the driver.

Defined results: null text has 0 words and takes 0; the null source is a source
of its own, last in order; documents without words and sources without words
take 0; an empty table gives no rows; every row is a document of its own, also
where its ``doc_id`` is null or repeated; re-runs agree, as nothing depends on
partitioning; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.llm.staging import ship_package, stage, unstage
from cinelake.llm.text import word_counts

BLOCK_WORDS = 512
#: Documents of a range of a stream, and slots of a range of the schedule, on average.
RANGE_DOCS, RANGE_SLOTS = 50_000, 1 << 16
#: 2**64 / golden ratio, odd: multiples modulo 2**64 are the sequence in fixed point.
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def targets(sizes: np.ndarray, weights: np.ndarray, share: float, most: float) -> np.ndarray:
    """Shares of ``share * sum(sizes)`` by weight, none above ``most`` times its
    size; what is above is shared again by weight among the others."""
    total, out = share * float(sizes.sum()), np.zeros(len(sizes))
    open_, limit = sizes > 0, most * sizes.astype(float)
    left = total
    while open_.any():
        part = left * weights / weights[open_].sum()
        over = open_ & (part > limit)
        if not over.any():
            out[open_] = part[open_]
            break
        out[over] = limit[over]
        left -= limit[over].sum()
        open_ &= ~over
    return out


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(word_counts(b.column("text")))], ["doc_id", "source", "size"])


def _slot_sources(bounds: np.ndarray):
    def run(batches):
        for b in batches:
            t = b.column("id").to_numpy(zero_copy_only=False)
            point = (t.astype(np.uint64) * GOLDEN) >> np.uint64(11)
            at = np.searchsorted(bounds, point.astype(np.float64) / 2.0**53, side="right")
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(np.minimum(at, len(bounds) - 1))], ["slot", "k"])

    return run


def schedule(spark, shares: np.ndarray, quotas: np.ndarray) -> DataFrame:
    """``(slot, k, rank)``: slots that count, ``k`` the source's index, ``rank``
    from 0 to its quota - 1 with none missing."""
    slots = int(quotas.sum())
    bounds = np.cumsum(shares)
    bounds = bounds / bounds[-1] if slots else np.ones(max(1, len(shares)))
    if slots:  # a point at or past the last bound belongs to the last source with a share
        last = int(np.flatnonzero(shares)[-1])
        bounds[last:] = 1.0
    drawn = spark.range(slots).mapInArrow(_slot_sources(bounds), "slot long, k long").withColumn("part", F.expr(f"slot div {RANGE_SLOTS}"))
    counts = drawn.groupBy("k", "part").agg(F.count("*").alias("c"))
    before = counts.withColumn("base", F.sum("c").over(Window.partitionBy("k").orderBy("part")) - F.col("c"))
    rank = F.col("base") + F.row_number().over(Window.partitionBy("k", "part").orderBy("slot")) - 1
    ranked = drawn.join(before.select("k", "part", "base"), ["k", "part"]).select("slot", "k", rank.alias("rank"))
    quota = spark.createDataFrame([(k, int(q)) for k, q in enumerate(quotas)], "k long, quota long")
    closing = (
        quota.join(counts.groupBy("k").agg(F.sum("c").alias("c")), "k", "left")
        .withColumn("c", F.coalesce("c", F.lit(0).cast("long")))
        .where("c < quota")
        .select((F.lit(slots) + F.col("k")).cast("long").alias("slot"), "k", F.explode(F.sequence("c", F.col("quota") - 1)).alias("rank"))
    )
    return ranked.join(quota, "k").where("rank < quota").select("slot", "k", "rank").unionByName(closing)


def mix(docs: DataFrame, weights: tuple[float, ...], share: float, most: float, block_words: int = BLOCK_WORDS, seed: int = 17) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, copies)`` per row:
    ``taken`` words of the document are in the mix; ``copies``: how often its
    first word is."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    sized = stage(rows.mapInArrow(_sizes, "doc_id long, source string, size long"), "sizes")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")).collect()
    per_source.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    size = np.array([r.source_size for r in per_source], np.int64)
    want = targets(size, np.array([float(weights[i % len(weights)]) for i in range(len(size))]), share, most)
    words = np.minimum(np.floor(want + 0.5).astype(np.int64), (most * size).astype(np.int64))
    blocks = -(-size // block_words)
    passes, rest = np.divmod(words, np.maximum(size, 1))
    quotas = passes * blocks + -(-rest // block_words)
    table = [(i, r.source, int(size[i]), float(want[i]), int(blocks[i]), int(passes[i]), int(rest[i])) for i, r in enumerate(per_source)]
    sources = spark.createDataFrame(table, "k long, source string, source_size long, target double, blocks long, passes long, rest long")

    # Places in the streams: totals of hash ranges, then running sums within a range.
    ranges = max(1, -(-sum(r.docs for r in per_source) // RANGE_DOCS))
    turn = F.xxhash64("doc_id", F.lit(seed))
    placed = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select("doc_id", sized["source"], "k", "size", "source_size", "target", "blocks", turn.alias("turn"))
    placed = placed.withColumn("part", F.expr(f"(shiftright(turn, 32) + 2147483648) * {ranges} div 4294967296"))
    totals = placed.groupBy("k", "part").agg(F.sum("size").alias("total"))
    starts = totals.withColumn("base", F.sum("total").over(Window.partitionBy("k").orderBy("part")) - F.col("total"))
    within = Window.partitionBy("k", "part").orderBy("turn", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("run", F.sum("size").over(within)).join(starts.select("k", "part", "base"), ["k", "part"])
    placed = placed.withColumn("start", F.col("base") + F.col("run") - F.col("size"))

    # A document's parts by block, joined with how often, and how far, the block is taken.
    # Its place, (k, start), tells it from all others with words.
    parts = placed.where("size > 0").select(
        "k", "start", "size",
        F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))).alias("block"),
    )
    taken_blocks = (
        schedule(spark, want, quotas)
        .join(sources.select("k", "blocks", "passes", "rest"), "k")
        .select("k", F.expr("rank % blocks").alias("block"), F.expr("rank div blocks").alias("pass"), "passes", "rest")
        .groupBy("k", "block")
        .agg(
            F.count(F.when(F.col("pass") < F.col("passes"), 1)).alias("whole"),
            F.max(F.when(F.col("pass") == F.col("passes"), F.col("rest"))).alias("upto"),
        )
    )
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    cut = F.least(high, F.coalesce("upto", F.lit(0).cast("long")))
    first = F.col("start") >= F.col("block") * block_words
    got = parts.join(taken_blocks, ["k", "block"]).groupBy("k", "start", "size").agg(
        F.sum(F.col("whole") * (high - low) + F.greatest(F.lit(0).cast("long"), cut - low)).alias("taken"),
        F.sum(F.when(first, F.col("whole") + (cut > F.col("start")).cast("long")).otherwise(0)).alias("copies"),
    )
    zero = F.lit(0).cast("long")
    out = placed.select("doc_id", "source", "source_size", "target", "k", "start", "size").join(got, ["k", "start", "size"], "left")
    out = out.select("doc_id", "source", "size", "source_size", "target", "taken", "copies")
    out = stage(out.withColumns({"taken": F.coalesce("taken", zero), "copies": F.coalesce("copies", zero)}), "mix")
    unstage(sized)
    return out
