"""Display-side expressions of the dashboards, computed in Spark.

Positions, genre block headers, placeholders for missing values, the
first-genre badge and the "only when rated" statistics block. Positions and
headers are computed only over size-limited results (top-k output, ≤ n rows
per genre); placeholders and badges are row-local.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinelake.functions.scalar import avg_of, genre_badge, or_placeholder
from cinelake.operators import stats
from cinelake.operators.topk import display_position
from cinelake.plans import analytics
from cinelake.plans.marts import top_n_per_genre


def _popular_with_key(fact: DataFrame, dim_movie: DataFrame, k: int) -> DataFrame:
    return analytics.popular(fact, dim_movie, k=k, keep_key=True)


def ranked_popular(fact: DataFrame, dim_movie: DataFrame, k: int = 5) -> DataFrame:
    """The popular-titles table with its 1-based display position."""
    top = _popular_with_key(fact, dim_movie, k)
    ranked = display_position(top, [F.col("total_ratings").desc(), F.col("movie_id").asc()])
    return ranked.select(F.col("position").cast("long").alias("position"), "title", "genre", "total_ratings", "avg_score")


def popular_badges(fact: DataFrame, dim_movie: DataFrame, k: int = 5) -> DataFrame:
    """Popular titles with the genre badge: first genre, or the dash."""
    top = _popular_with_key(fact, dim_movie, k)
    return top.select("title", genre_badge("genre").alias("genre_badge"), "total_ratings", "avg_score")


def genre_headers(fact: DataFrame, dim_movie: DataFrame, n: int = 10) -> DataFrame:
    """The top-n-per-genre table with a flag on the first row of every
    genre block (where the genre differs from the previous row)."""
    mart = top_n_per_genre(fact, dim_movie, n)
    prev = F.lag("primary_genre").over(Window.partitionBy("primary_genre").orderBy("rk"))
    return mart.select(
        "primary_genre",
        "title",
        "avg_score",
        "total_ratings",
        F.col("rk").cast("long").alias("rk"),
        prev.isNull().alias("is_header"),
    )


def catalog_display(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Catalogue as shown: missing, blank and zero values become the dash;
    the rating badge is shown only for a non-zero rating."""
    sums = stats.by_movie(ratings, rating_id="id").withColumnRenamed("movie_id", "imdb_id")
    j = movies.join(sums, "imdb_id", "left")
    return j.select(
        "imdb_id",
        "title",
        or_placeholder("genre", zero_is_missing=False).alias("genre"),
        or_placeholder("year").alias("year"),
        or_placeholder("country", zero_is_missing=False).alias("country"),
        or_placeholder("imdb_rating").alias("imdb_rating"),
        (F.coalesce(F.col("imdb_rating"), F.lit(0)) != 0).alias("rating_badge"),
        stats.rating_count(outer=True).alias("num_ratings"),
        or_placeholder(stats.avg_score()).alias("avg_score"),
    )


def catalog_size(movies: DataFrame) -> DataFrame:
    """Number of titles listed in the catalogue."""
    return movies.agg(F.count(F.lit(1)).alias("num_titles"))


def stats_if_rated(movies: DataFrame, ratings: DataFrame) -> DataFrame:
    """Per title: the statistics block is shown only when it has ratings."""
    per = ratings.groupBy("movie_id").agg(
        F.count(F.lit(1)).alias("total"),
        avg_of("score").alias("avg"),
        F.max("score").alias("max_score"),
        F.min("score").alias("min_score"),
    ).withColumnRenamed("movie_id", "imdb_id")
    j = movies.select("imdb_id").join(per, "imdb_id", "left")
    total = F.coalesce(F.col("total"), F.lit(0).cast("long"))
    shown = total > 0
    return j.select(
        "imdb_id",
        total.alias("total"),
        shown.alias("show_stats"),
        F.when(shown, or_placeholder("avg")).alias("avg"),
        F.when(shown, F.col("max_score")).alias("max_score"),
        F.when(shown, F.col("min_score")).alias("min_score"),
    )
