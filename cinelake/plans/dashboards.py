"""Front page, catalogue and title-detail queries over the application
tables (``movies`` keyed by ``imdb_id``, ``users`` by ``id``, ``ratings``
with its own ``id``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.scalar import avg_of
from cinelake.operators import stats
from cinelake.operators.topk import top_k


def _movie_sums(ratings: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    title_sums = stats.by_movie(ratings, rating_id="id") if sums is None else sums
    return title_sums.withColumnRenamed("movie_id", "imdb_id")


def _with_rating_stats(movies: DataFrame, ratings: DataFrame, cols: list[str],
                       sums: DataFrame | None = None) -> DataFrame:
    """Titles left-joined to their rating sums: unrated titles keep count 0
    and a NULL average (``COUNT(r.id)`` counts matches only)."""
    joined = movies.select(*cols).join(_movie_sums(ratings, sums), "imdb_id", "left")
    return joined.select(
        *cols,
        stats.rating_count(outer=True).alias("num_ratings"),
        stats.avg_score().alias("avg_score"),
    )


def top_rated(movies: DataFrame, ratings: DataFrame, k: int = 5, sums: DataFrame | None = None) -> DataFrame:
    """Front page: the ``k`` most-rated titles, unrated ones included."""
    cols = ["imdb_id", "title", "genre", "year", "imdb_rating"]
    return top_k(
        _with_rating_stats(movies, ratings, cols, sums),
        k,
        [F.col("num_ratings").desc(), F.col("imdb_id").asc()],
    )


def totals(movies: DataFrame, users: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row: number of titles, users and ratings, and the overall average.

    The three tables are projected to a tag and the score and unioned, so a
    single scan-and-aggregate job answers all four figures (partial
    aggregation per task, one tiny final merge) with no join.
    """
    score_type = ratings.schema["score"].dataType
    tagged = (
        movies.select(F.lit(1).alias("src"), F.lit(None).cast(score_type).alias("score"))
        .unionByName(users.select(F.lit(2).alias("src"), F.lit(None).cast(score_type).alias("score")))
        .unionByName(ratings.select(F.lit(3).alias("src"), F.col("score")))
    )
    return tagged.agg(
        F.count_if(F.col("src") == 1).alias("total_movies"),
        F.count_if(F.col("src") == 2).alias("total_users"),
        F.count_if(F.col("src") == 3).alias("total_ratings"),
        avg_of("score").alias("avg_rating"),
    )


def totals_from_sums(movies: DataFrame, users: DataFrame, title_sums: DataFrame) -> DataFrame:
    """The four totals when per-title sums are already available: ratings
    and the overall average re-aggregate exactly from them."""
    score_sum_type = title_sums.schema[stats.SUM_SCORE].dataType
    tagged = (
        movies.select(F.lit(1).alias("src"), *[F.lit(None).cast(t).alias(c) for c, t in (
            (stats.SUM_SCORE, score_sum_type), (stats.N_SCORED, "long"), (stats.N_RATINGS, "long"))])
        .unionByName(users.select(F.lit(2).alias("src"), *[F.lit(None).cast(t).alias(c) for c, t in (
            (stats.SUM_SCORE, score_sum_type), (stats.N_SCORED, "long"), (stats.N_RATINGS, "long"))]))
        .unionByName(title_sums.select(F.lit(3).alias("src"), stats.SUM_SCORE, stats.N_SCORED, stats.N_RATINGS))
    )
    return tagged.agg(
        F.count_if(F.col("src") == 1).alias("total_movies"),
        F.count_if(F.col("src") == 2).alias("total_users"),
        F.coalesce(F.sum(stats.N_RATINGS), F.lit(0).cast("long")).alias("total_ratings"),
        stats.rounded_avg_expr().alias("avg_rating"),
    )


def catalog(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Every title with its rating count and average, ordered by title."""
    cols = ["imdb_id", "title", "genre", "year", "country", "imdb_rating"]
    return _with_rating_stats(movies, ratings, cols).orderBy(
        F.col("title").asc_nulls_last(), F.col("imdb_id").asc()
    )


def movie(movies: DataFrame, imdb_id: str) -> DataFrame:
    """One title's record (empty when the id is unknown)."""
    return movies.where(F.col("imdb_id") == F.lit(imdb_id))


def movie_ratings(ratings: DataFrame, users: DataFrame, imdb_id: str) -> DataFrame:
    """One title's ratings with rater attributes, newest first.

    The filter is applied before the join and pushed into the scan.
    """
    r = ratings.where(F.col("movie_id") == F.lit(imdb_id)).select("user_id", "score", "rated_at")
    u = users.select(F.col("id").alias("user_id"), "name", "age_group", "country")
    return r.join(u, "user_id", "inner").select(
        "name", "age_group", "country", "score", "rated_at"
    ).orderBy(
        F.col("rated_at").desc_nulls_first(),
        F.col("name").asc_nulls_last(),
        F.col("score").desc_nulls_first(),
    )


def movie_stats(ratings: DataFrame, imdb_id: str) -> DataFrame:
    """One title's count, average, best and worst score — always one row."""
    r = ratings.where(F.col("movie_id") == F.lit(imdb_id))
    return r.agg(
        F.count(F.lit(1)).cast(T.LongType()).alias("total"),
        avg_of("score").alias("avg"),
        F.max("score").alias("max_score"),
        F.min("score").alias("min_score"),
    )
