"""Top-k and top-k-per-group.

``orderBy(...).limit(k)`` is planned as ``TakeOrderedAndProject``: every
partition keeps its own k best rows and only k × partitions rows reach the
final merge, so no full sort happens.

Top-k per group uses ``row_number()`` with a ``rk <= n`` filter, which
Catalyst turns into a partial ``WindowGroupLimit`` before the shuffle and a
final one after it: a group that holds a third of all rows still sends at
most n rows per map task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The first ``k`` rows under a total ``order`` (include a key tie-break)."""
    if k < 0:
        raise ValueError("k must be non-negative")
    return df.orderBy(*order).limit(k)


def top_n_per_group(
    df: DataFrame,
    group: Sequence[str | Column],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rk",
) -> DataFrame:
    """Rows ranked 1..n inside each group by ``order`` (ROW_NUMBER semantics)."""
    if n < 0:
        raise ValueError("n must be non-negative")
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def display_position(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """1-based position in ``order`` for an already size-limited result.

    Uses a window without partitioning, so callers must only pass results
    whose size is bounded by a limit (top-k output).
    """
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
