"""The SQL surface: mart views that live in the warehouse database, and reports.

The views are defined over the public table names, not over a version, so they
follow every later load and outlive the session that made them (given a
persistent catalog). Each statement first reduces the ratings to one row per
title or user and only then meets the dimension, so the shuffle carries sums.
Rules are those of the DataFrame functions: exact averages rounded once, NULLs
first under DESC, ties broken by key; a view states no order, its reader does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cinelake.fixed_values import TOP_COUNTRIES, TOP_GENRES, TOP_PER_GENRE, TOP_POPULAR

# Re-aggregatable sums of the ratings, by one key.
_SUMS = "sum(score) AS points, count(score) AS scored, count(rating_id) AS rated"
_PER_TITLE = "per_title AS (SELECT movie_id, {sums} FROM {db}fact_rating GROUP BY movie_id)"
_PER_USER = "per_user AS (SELECT user_id, {sums} FROM {db}fact_rating GROUP BY user_id)"
# Averages of one reduced row, and of a group of them.
_EXACT = "try_divide(points, scored)"
_MEAN = "round(try_divide(sum(points), sum(scored)), 2)"

_BY_ATTRIBUTE = """
WITH {per_user}
SELECT who.{attribute}, {columns}
FROM {db}dim_user who INNER JOIN per_user USING (user_id)
WHERE who.{attribute} IS NOT NULL
GROUP BY who.{attribute}"""

_VIEWS = {
    "mart_top10_by_genre": """
WITH {per_title},
placed AS (
  SELECT split_part(genre, ',', 1) AS primary_genre, movie_id, title, rated,
         {exact} AS mean
  FROM {db}dim_movie INNER JOIN per_title USING (movie_id)
  WHERE genre IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY primary_genre
                               ORDER BY mean DESC NULLS FIRST, rated DESC, movie_id) AS place
  FROM placed)
SELECT primary_genre, movie_id, title, round(mean, 2) AS avg_score, rated AS total_ratings
FROM numbered WHERE place <= {per_genre}""",
    "mart_avg_by_age_group": _BY_ATTRIBUTE.replace("{attribute}", "age_group").replace(
        "{columns}", "{mean} AS avg_score, sum(rated) AS total_ratings"),
    "mart_ratings_by_country": _BY_ATTRIBUTE.replace("{attribute}", "country").replace(
        "{columns}", "sum(rated) AS total_ratings, {mean} AS avg_score"),
}

_REPORTS = {
    "popular_titles": """
WITH {per_title}
SELECT title, genre, rated AS total_ratings, round({exact}, 2) AS avg_score
FROM {db}dim_movie INNER JOIN per_title USING (movie_id)
ORDER BY rated DESC, movie_id LIMIT {popular}""",
    "best_genres": """
WITH {per_title},
labelled AS (
  SELECT split_part(genre, ',', 1) AS primary_genre, points, scored, rated
  FROM {db}dim_movie INNER JOIN per_title USING (movie_id)
  WHERE genre IS NOT NULL)
SELECT primary_genre, sum(rated) AS total_ratings, {mean} AS avg_score
FROM labelled GROUP BY primary_genre
ORDER BY avg_score DESC NULLS FIRST, primary_genre LIMIT {genres}""",
    "active_countries": """
WITH seen AS (
  SELECT user_id, movie_id, {sums} FROM {db}fact_rating GROUP BY user_id, movie_id)
SELECT country, sum(rated) AS total_ratings, count(DISTINCT movie_id) AS distinct_movies_watched,
       {mean} AS avg_score
FROM {db}dim_user INNER JOIN seen USING (user_id)
WHERE country IS NOT NULL
GROUP BY country
ORDER BY total_ratings DESC, country LIMIT {countries}""",
}


def _filled(body: str, database: str | None) -> str:
    db = f"`{database}`." if database else ""
    parts = {"db": db, "sums": _SUMS, "exact": _EXACT, "mean": _MEAN, "per_genre": TOP_PER_GENRE,
             "popular": TOP_POPULAR, "genres": TOP_GENRES, "countries": TOP_COUNTRIES}
    parts["per_title"] = _PER_TITLE.format(**parts)
    parts["per_user"] = _PER_USER.format(**parts)
    return body.format(**parts)


def register_star(spark: SparkSession, fact: DataFrame, dim_movie: DataFrame, dim_user: DataFrame) -> None:
    """Expose a star schema as session views for SQL users."""
    fact.createOrReplaceTempView("fact_rating")
    dim_movie.createOrReplaceTempView("dim_movie")
    dim_user.createOrReplaceTempView("dim_user")


def create_mart_views(spark: SparkSession, database: str | None = None) -> None:
    """``CREATE OR REPLACE`` the three mart views: in ``database``, over its
    tables, or as session views over a registered star."""
    for name, body in _VIEWS.items():
        target = f"VIEW `{database}`.`{name}`" if database else f"TEMP VIEW `{name}`"
        spark.sql(f"CREATE OR REPLACE {target} AS {_filled(body, database)}")


def report(spark: SparkSession, name: str, database: str | None = None) -> DataFrame:
    """Run one analytical report over a database, or over the registered star."""
    return spark.sql(_filled(_REPORTS[name], database))
