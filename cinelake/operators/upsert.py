"""Set-based upsert and full refresh.

The reference upserts row by row (``INSERT … ON CONFLICT DO UPDATE``), so
the last occurrence of a key in the batch wins and keys absent from the
batch keep their row. The same result set-wise:

1. reduce the batch to one row per key — the one at the greatest position —
   with ``max_by`` (a partial aggregate, so a key repeated in a third of the
   batch is pre-reduced on every map task);
2. keep base rows whose key is not in the reduced batch (``left_anti``);
3. union the two.

Writes are staged: the new version goes to a fresh directory and replaces
the old one only after it is complete, so a failed load never leaves an
empty or half-written table and the table being read is never overwritten
in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.session import staging_path


def latest_per_key(batch: DataFrame, key: str, position: str) -> DataFrame:
    """One row per ``key``: the row with the greatest ``position``."""
    values = [c for c in batch.columns if c not in (key, position)]
    reduced = batch.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(c) for c in values]), F.col(position)).alias("_row")
    )
    return reduced.select(key, *[F.col(f"_row.{c}").alias(c) for c in values])


def first_per_key(batch: DataFrame, key: str, position: str) -> DataFrame:
    """One row per ``key``: the row with the smallest ``position`` (kept)."""
    values = [c for c in batch.columns if c != key]
    reduced = batch.groupBy(key).agg(
        F.min_by(F.struct(*[F.col(c) for c in values]), F.col(position)).alias("_row")
    )
    return reduced.select(key, *[F.col(f"_row.{c}").alias(c) for c in values])


def upsert(base: DataFrame, batch: DataFrame, key: str, position: str) -> DataFrame:
    """``base`` updated by ``batch`` (last row per key wins, others kept).

    ``batch`` must have ``base``'s columns plus ``position``.
    """
    latest = latest_per_key(batch.select(*base.columns, position), key, position)
    survivors = base.join(latest.select(key), key, "left_anti")
    return survivors.unionByName(latest.select(*base.columns))


def staged_write(spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet") -> str:
    """Write ``df`` to a new directory under the shared checkpoint folder
    and return its path; the caller switches readers to it afterwards."""
    path = staging_path(spark, name)
    df.write.format(fmt).mode("errorifexists").save(path)
    return path


def full_refresh(spark: SparkSession, new_rows: DataFrame, name: str) -> DataFrame:
    """Truncate-and-reload as a staged write: returns the reloaded table.

    Running it twice with the same input gives equal tables.
    """
    path = staged_write(spark, new_rows, name)
    return spark.read.parquet(path)
