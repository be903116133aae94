"""Selection and seeded sampling operators of the lake generator.

* ``quota_select`` — scan candidates in order and accept each into the first
  target (in priority order) that its text contains and whose quota is
  still open, skipping ids already seen. The sequential rule equals a
  cascade: target 1 takes the first ``quota`` candidates that contain it;
  target 2 the first ``quota`` of the rest that contain it; and so on
  (acceptance by an earlier target never depends on a later one). It runs
  over a short list of bounded size, taken in one pass.
* ``sample_k`` — k distinct items per key with a hash stride over a dense
  item index: ``start = h1 mod N``, ``step = 1 + h2 mod ⌊N/k⌋``, item j is
  ``(start + j·step) mod N`` for j < k, distinct because
  ``(k−1)·step < N``. No cross join: k rows per key join the index.
* ``assign_categories`` / ``synthetic_scores`` — seeded values from an md5
  of (seed, key), reproducible in any engine.

Only the contract (k distinct per key, value domains, determinism for a
seed) matches the reference generator, not its pseudo-random stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.operators.keys import dense_index
from cinelake.operators.upsert import first_per_key
from cinelake.schemas import SCORE_TYPE

from cinelake.fixed_values import (
    AGE_GROUPS,
    COUNTRIES,
    RATED_AT,
    RATINGS_PER_USER,
    SCORE_MAX,
    SCORE_MIN,
    SEED,
)


# ---------------------------------------------------------------------------
# Priority-quota selection
# ---------------------------------------------------------------------------

def dedupe_first(candidates: DataFrame, id_col: str, position: str) -> DataFrame:
    """First occurrence (smallest position) of every id."""
    return first_per_key(candidates, id_col, position)


def _free(priority: int, id_col: str) -> Column:
    """Listed candidates of one target that no earlier target has taken."""

    def open_(x: Column) -> Column:
        return (x["priority"] == priority) & ~F.exists("taken", lambda y: y["row"][id_col] == x["row"][id_col])

    return F.filter("list", open_)


def quota_select(
    candidates: DataFrame,
    targets: Sequence[str],
    quota: int,
    id_col: str = "id",
    position: str = "pos",
    text_col: str = "genre",
    target_col: str = "target",
) -> DataFrame:
    """Accepted candidates with the target each was accepted for.

    One pass over the candidates: each is exploded over the targets that it
    contains, and per target the first ``quota × targets`` are kept (a window
    group limit). An earlier target takes at most ``quota`` candidates away, so
    that many always suffice. The cascade then runs on the kept list, at most
    ``quota × targets²`` rows, which configuration bounds.
    """
    if not targets:
        return candidates.limit(0).withColumn(target_col, F.lit(None).cast(T.StringType()))
    rows = dedupe_first(candidates, id_col, position)
    text = F.coalesce(F.col(text_col), F.lit(""))
    contained = F.array_compact(F.array(*[F.when(text.contains(F.lit(t)), F.lit(i)) for i, t in enumerate(targets)]))
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    each = rows.select(row, F.explode(contained).alias("priority"))
    order = Window.partitionBy("priority").orderBy(F.col(f"row.{position}"), F.col(f"row.{id_col}"))
    short = each.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= quota * len(targets))
    listed = short.groupBy().agg(
        F.collect_list(F.struct("priority", "turn", "row")).alias("list")
    ).select(F.array_sort("list", lambda x, y: F.when(x["priority"] != y["priority"], x["priority"] - y["priority"]).otherwise(x["turn"] - y["turn"])).alias("list"))

    accepted = F.filter("list", lambda x: F.lit(False))
    for i in range(len(targets)):
        # Bound as a column of its own, so that the next step reads it once.
        listed = listed.withColumn("taken", accepted)
        accepted = F.concat("taken", F.slice(_free(i, id_col), 1, quota))
    names = F.array(*[F.lit(t) for t in targets])
    taken = listed.select(F.explode(accepted).alias("x"))
    return taken.select("x.row.*", F.element_at(names, F.col("x.priority") + 1).alias(target_col))


def quota_counts(accepted: DataFrame, targets: Sequence[str], target_col: str = "target") -> DataFrame:
    """Accepted count per target (0 for targets nothing went to) and the
    running total over all targets."""
    spark = accepted.sparkSession
    names = spark.createDataFrame([(i, t) for i, t in enumerate(targets)], f"priority int, {target_col} string")
    counts = accepted.groupBy(target_col).agg(F.count(F.lit(1)).alias("accepted"))
    # ``names`` has one row per configured target: a bounded side.
    joined = F.broadcast(names).join(counts, target_col, "left")
    return joined.select(
        target_col,
        F.coalesce(F.col("accepted"), F.lit(0).cast("long")).alias("accepted"),
        # One row per target: an un-partitioned window over a bounded set.
        F.sum(F.coalesce(F.col("accepted"), F.lit(0).cast("long"))).over(Window.partitionBy()).alias(
            "total_accepted"
        ),
    )


# ---------------------------------------------------------------------------
# Seeded hashing
# ---------------------------------------------------------------------------

def seeded_hash(seed: int, *parts: Column | str, salt: str = "", offset: int = 0, digits: int = 8) -> Column:
    """Unsigned integer of ``digits`` hex digits (15 at most) from
    md5(seed|salt|parts...), as BIGINT.

    ``offset`` picks which run of ``digits`` of the digest to use.
    """
    pieces: list[Column] = [F.lit(str(seed))]
    if salt:
        pieces += [F.lit("|"), F.lit(salt)]
    for p in parts:
        pieces += [F.lit("|"), (F.col(p) if isinstance(p, str) else p).cast(T.StringType())]
    digest = F.md5(F.concat(*pieces))
    return F.conv(F.substring(digest, 1 + digits * offset, digits), 16, 10).cast(T.LongType())


def sample_k(
    keys: DataFrame,
    items: DataFrame,
    key_col: str,
    item_col: str,
    k: int = RATINGS_PER_USER,
    seed: int = SEED,
) -> DataFrame:
    """``min(k, N)`` distinct items per key (N = number of items)."""
    if k <= 0:
        return keys.select(key_col, F.lit(None).cast(items.schema[item_col].dataType).alias(item_col),
                           F.lit(0).alias("draw")).limit(0)
    indexed = dense_index(items.select(item_col), [F.col(item_col).asc()], name="_idx", start=0)
    n = indexed.select(F.count(F.lit(1))).scalar()
    kk = F.least(F.lit(k).cast("long"), n)
    h1 = seeded_hash(seed, key_col, offset=0, digits=15)
    h2 = seeded_hash(seed, key_col, offset=1, digits=15)
    draws = keys.select(key_col).where(n > 0).select(
        key_col,
        F.pmod(h1, n).alias("_start"),
        (F.lit(1) + F.pmod(h2, F.floor(n / kk))).alias("_step"),
        F.explode(F.sequence(F.lit(0).cast("long"), kk - 1)).alias("draw"),
    )
    picks = draws.select(
        key_col, "draw", F.pmod(F.col("_start") + F.col("draw") * F.col("_step"), n).alias("_idx")
    )
    return picks.join(indexed, "_idx", "inner").select(key_col, item_col, F.col("draw").cast("int").alias("draw"))


def assign_categories(
    keys: DataFrame,
    key_col: str,
    seed: int = SEED,
    age_groups: Sequence[str] = AGE_GROUPS,
    countries: Sequence[str] = COUNTRIES,
) -> DataFrame:
    """Seeded age group and country per key, uniform over each list."""
    ages = F.array(*[F.lit(a) for a in age_groups])
    ctry = F.array(*[F.lit(c) for c in countries])
    return keys.select(
        key_col,
        F.element_at(ages, (F.pmod(seeded_hash(seed, key_col, salt="age"), len(age_groups)) + 1).cast("int")).alias(
            "age_group"
        ),
        F.element_at(ctry, (F.pmod(seeded_hash(seed, key_col, salt="country"), len(countries)) + 1).cast("int")).alias(
            "country"
        ),
    )


def synthetic_scores(
    pairs: DataFrame,
    key_cols: Sequence[str],
    seed: int = SEED,
    rated_at: str = RATED_AT,
) -> DataFrame:
    """Seeded score uniform in [1.0, 10.0] rounded to one decimal, and a
    fixed rating date (other columns of ``pairs`` pass through). Integer
    arithmetic only:
    ``tenths = (10·2³² + 90·h + 2³¹) div 2³²`` for a 32-bit hash ``h``."""
    h = seeded_hash(seed, *key_cols, salt="score")
    two32 = 1 << 32
    lo, span = int(SCORE_MIN * 10), int((SCORE_MAX - SCORE_MIN) * 10)
    tenths = F.shiftright(F.lit(lo * two32) + F.lit(span) * h + F.lit(two32 // 2), 32)
    return pairs.select(
        *pairs.columns,
        (tenths.cast(T.DecimalType(6, 0)) / F.lit(10)).cast(SCORE_TYPE).alias("score"),
        F.to_date(F.lit(rated_at)).alias("rated_at"),
    )
