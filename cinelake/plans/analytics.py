"""Analytical questions over the star schema (most popular titles, best
genres, most active countries)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.functions.scalar import avg_of, first_genre
from cinelake.operators import stats
from cinelake.operators.joins import fits_broadcast
from cinelake.operators.topk import top_k


def popular(fact: DataFrame, dim_movie: DataFrame, k: int = 5, with_genre: bool = True,
            sums: DataFrame | None = None, keep_key: bool = False) -> DataFrame:
    """The ``k`` titles with most ratings (ties broken by ``movie_id``).

    ``sums`` may carry precomputed per-title sums (``stats.by_movie``) shared
    with other queries of a page; ``keep_key`` keeps ``movie_id`` in the
    output (for display positions that follow the same order).
    """
    cols = ["movie_id", "title"] + (["genre"] if with_genre else [])
    title_sums = stats.by_movie(fact) if sums is None else sums
    joined = title_sums.join(dim_movie.select(*cols), "movie_id", "inner")
    ranked = top_k(
        joined.select(
            *cols,
            F.col(stats.N_RATINGS).alias("total_ratings"),
            stats.avg_score().alias("avg_score"),
        ),
        k,
        [F.col("total_ratings").desc(), F.col("movie_id").asc()],
    )
    return ranked.select(*(cols if keep_key else cols[1:]), "total_ratings", "avg_score")


def _genre_sums(fact: DataFrame, dim_movie: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    titles = dim_movie.where(F.col("genre").isNotNull()).select("movie_id", "genre")
    title_sums = stats.by_movie(fact) if sums is None else sums
    return title_sums.join(titles, "movie_id", "inner")


def best_genres(fact: DataFrame, dim_movie: DataFrame, k: int = 10,
                sums: DataFrame | None = None) -> DataFrame:
    """Primary genres by rounded average rating, best first."""
    g = stats.regroup(
        _genre_sums(fact, dim_movie, sums).withColumn("primary_genre", first_genre("genre")),
        ["primary_genre"],
    )
    return top_k(
        g.select(
            "primary_genre",
            F.col(stats.N_RATINGS).alias("total_ratings"),
            stats.avg_score().alias("avg_score"),
        ),
        k,
        [F.col("avg_score").desc_nulls_first(), F.col("primary_genre").asc()],
    )


def best_genre_lists(fact: DataFrame, dim_movie: DataFrame, k: int = 10,
                     sums: DataFrame | None = None) -> DataFrame:
    """Dashboard variant: grouped by the *full* genre list, labelled by its
    first item, so one label can appear more than once."""
    g = stats.regroup(_genre_sums(fact, dim_movie, sums), ["genre"])
    ranked = top_k(
        g.select(
            "genre",
            stats.avg_score().alias("avg_score"),
            F.col(stats.N_RATINGS).alias("num_ratings"),
        ),
        k,
        [F.col("avg_score").desc_nulls_first(), F.col("genre").asc()],
    )
    return ranked.select(first_genre("genre").alias("genre"), "avg_score", "num_ratings")


def countries(fact: DataFrame, dim_user: DataFrame, k: int = 10, distinct: bool = True) -> DataFrame:
    """User countries by number of ratings, most first.

    If the user side provably fits the broadcast budget, the fact joins it
    in place. Otherwise the fact is pre-aggregated before the shuffle join —
    per user, or per (user, title) when distinct titles are counted — so a
    hot user is collapsed on every map task. Distinct titles per country
    come from (country, title) groups, re-aggregated exactly.
    """
    users = dim_user.where(F.col("country").isNotNull()).select("user_id", "country")
    small = fits_broadcast(users)
    if distinct:
        if small:
            g = fact.join(F.broadcast(users), "user_id", "inner").groupBy("country").agg(
                F.count("rating_id").alias("total_ratings"),
                F.count_distinct("movie_id").alias("distinct_movies_watched"),
                avg_of("score").alias("avg_score"),
            )
        else:
            pairs = stats.rating_sums(fact, ["user_id", "movie_id"]).join(users, "user_id", "inner")
            per_title = stats.regroup(pairs, ["country", "movie_id"])
            g = per_title.groupBy("country").agg(
                F.sum(stats.N_RATINGS).alias("total_ratings"),
                F.count(F.lit(1)).alias("distinct_movies_watched"),
                stats.rounded_avg_expr().alias("avg_score"),
            )
        cols = ["country", "total_ratings", "distinct_movies_watched", "avg_score"]
    else:
        if small:
            joined = fact.select("user_id", "rating_id", "score").join(F.broadcast(users), "user_id", "inner")
            sums = stats.rating_sums(joined, ["country"])
        else:
            sums = stats.regroup(stats.by_user(fact).join(users, "user_id", "inner"), ["country"])
        g = sums.select(
            "country",
            F.col(stats.N_RATINGS).alias("total_ratings"),
            stats.avg_score().alias("avg_score"),
        )
        cols = ["country", "total_ratings", "avg_score"]
    return top_k(g.select(*cols), k, [F.col("total_ratings").desc(), F.col("country").asc()])
