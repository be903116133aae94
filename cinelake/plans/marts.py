"""The three mart views over the star schema.

Results keep the warehouse types (exact decimals); the query registry casts
at its edge. NULL order and tie-breaks are explicit: the reference's
database puts NULLs first under DESC, and every ordering ends with the group
or primary key so ties cannot make results differ between runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalar import first_genre
from cinelake.operators import stats
from cinelake.operators.joins import fits_broadcast
from cinelake.operators.topk import top_k, top_n_per_group

MART_VIEWS = ("mart_top10_by_genre", "mart_avg_by_age_group", "mart_ratings_by_country")


def _scored_titles(fact: DataFrame, dim_movie: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """Per-title partial sums joined to titles that have a genre."""
    titles = dim_movie.where(F.col("genre").isNotNull()).select(
        first_genre("genre").alias("primary_genre"), "movie_id", "title"
    )
    title_sums = stats.by_movie(fact) if sums is None else sums
    return title_sums.join(titles, "movie_id", "inner")


def top_n_per_genre(fact: DataFrame, dim_movie: DataFrame, n: int = 10,
                    sums: DataFrame | None = None) -> DataFrame:
    """Top ``n`` titles per primary genre by exact average, then count.

    Ranking uses the unrounded average (a title with only NULL scores ranks
    first); the output shows the rounded one. Ordered by genre, then rank.
    """
    ranked = top_n_per_group(
        _scored_titles(fact, dim_movie, sums),
        ["primary_genre"],
        [stats.exact_avg().desc_nulls_first(), F.col(stats.N_RATINGS).desc(), F.col("movie_id").asc()],
        n,
    )
    return ranked.select(
        "primary_genre",
        "movie_id",
        "title",
        stats.avg_score().alias("avg_score"),
        F.col(stats.N_RATINGS).alias("total_ratings"),
        "rk",
    ).orderBy(F.col("primary_genre").asc_nulls_last(), "rk")


def top_n_display(fact: DataFrame, dim_movie: DataFrame, n: int = 10,
                  sums: DataFrame | None = None) -> DataFrame:
    """Dashboard projection of the mart (no key), order re-stated."""
    return top_n_per_genre(fact, dim_movie, n, sums).select(
        "primary_genre", "title", "avg_score", "total_ratings", "rk"
    ).orderBy(F.col("primary_genre").asc_nulls_last(), "rk")


def _by_user_attribute(fact: DataFrame, dim_user: DataFrame, attribute: str,
                       user_sums: DataFrame | None = None) -> DataFrame:
    """Partial sums per user attribute (age group, country).

    If the user side provably fits the broadcast budget, the fact joins it
    in place (no shuffle of the fact; the aggregation by attribute is then
    partial per task). Otherwise the fact is first reduced per user — the
    partial aggregate collapses a user holding a third of the ratings on
    every map task — and only those sums are shuffled to meet the users.
    """
    users = dim_user.where(F.col(attribute).isNotNull()).select("user_id", attribute)
    if user_sums is not None:
        # Per-user sums already computed (and shared) by the caller.
        return stats.regroup(user_sums.join(users, "user_id", "inner"), [attribute])
    if fits_broadcast(users):
        joined = fact.select("user_id", "rating_id", "score").join(F.broadcast(users), "user_id", "inner")
        return stats.rating_sums(joined, [attribute])
    return stats.regroup(stats.by_user(fact).join(users, "user_id", "inner"), [attribute])


def avg_by_age_group(fact: DataFrame, dim_user: DataFrame, user_sums: DataFrame | None = None) -> DataFrame:
    """Average and count per age group, best (rounded) average first."""
    g = _by_user_attribute(fact, dim_user, "age_group", user_sums)
    return g.select(
        "age_group",
        stats.avg_score().alias("avg_score"),
        F.col(stats.N_RATINGS).alias("total_ratings"),
    ).orderBy(F.col("avg_score").desc_nulls_first(), F.col("age_group").asc())


def ratings_by_country(fact: DataFrame, dim_user: DataFrame, user_sums: DataFrame | None = None) -> DataFrame:
    """Ratings and average per user country, most ratings first."""
    g = _by_user_attribute(fact, dim_user, "country", user_sums)
    return g.select(
        "country",
        F.col(stats.N_RATINGS).alias("total_ratings"),
        stats.avg_score().alias("avg_score"),
    ).orderBy(F.col("total_ratings").desc(), F.col("country").asc())


def country_top(fact: DataFrame, dim_user: DataFrame, k: int = 10,
                user_sums: DataFrame | None = None) -> DataFrame:
    """First ``k`` rows of the country mart, renamed for the dashboard."""
    g = ratings_by_country(fact, dim_user, user_sums)
    return top_k(
        g.select("country", F.col("total_ratings").alias("num_ratings"), "avg_score"),
        k,
        [F.col("num_ratings").desc(), F.col("country").asc()],
    )

