"""Shared, re-aggregatable rating aggregates.

Every average in the reference is ``ROUND(AVG(score), 2)`` and every count
is ``COUNT(rating_id)``. Both decompose into sums and counts, which
re-aggregate exactly (averages of averages do not). Aggregating the fact by
its join key *before* joining a dimension (eager aggregation) is valid
because dimension keys are unique, and it shrinks the shuffled side from one
row per rating to one row per key. Partial (map-side) aggregation also
collapses a hot key — a title holding a third of all ratings becomes one row
per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalar import exact_ratio, rounded_avg

# Column names of the partial aggregate.
SUM_SCORE = "sum_score"
N_SCORED = "n_scored"
N_RATINGS = "n_ratings"


def rating_sums(
    fact: DataFrame,
    keys: Sequence[str],
    score: str = "score",
    rating_id: str = "rating_id",
) -> DataFrame:
    """``keys`` → sum of scores, count of non-NULL scores, count of ratings."""
    return fact.groupBy(*keys).agg(
        F.sum(score).alias(SUM_SCORE),
        F.count(score).alias(N_SCORED),
        F.count(rating_id).alias(N_RATINGS),
    )


def by_movie(fact: DataFrame, movie_id: str = "movie_id", rating_id: str = "rating_id") -> DataFrame:
    return rating_sums(fact, [movie_id], rating_id=rating_id)


def by_user(fact: DataFrame, user_id: str = "user_id", rating_id: str = "rating_id") -> DataFrame:
    return rating_sums(fact, [user_id], rating_id=rating_id)


def regroup(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Re-aggregate partial sums to coarser ``keys`` (exact)."""
    return sums.groupBy(*keys).agg(
        F.sum(SUM_SCORE).alias(SUM_SCORE),
        F.sum(N_SCORED).alias(N_SCORED),
        F.sum(N_RATINGS).alias(N_RATINGS),
    )


def avg_score() -> "F.Column":
    """Rounded average from the partial sums (NULL when nothing was scored)."""
    return rounded_avg(F.col(SUM_SCORE), F.col(N_SCORED))


def exact_avg() -> "F.Column":
    """Unrounded average, used as a ranking key."""
    return exact_ratio(F.col(SUM_SCORE), F.col(N_SCORED))


def rating_count(outer: bool = False) -> "F.Column":
    """``COUNT(rating_id)``; after an outer join unmatched rows count 0."""
    c = F.col(N_RATINGS)
    return F.coalesce(c, F.lit(0).cast("long")) if outer else c


def rounded_avg_expr() -> "F.Column":
    """Aggregate expression: rounded average from partial-sum columns."""
    return rounded_avg(F.sum(SUM_SCORE), F.sum(N_SCORED))
