"""Fixed schemas of the lake, the app tables and the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

from cinelake.fixed_values import MAX_LENGTH  # noqa: F401 - re-exported

# Lake: headered CSV files, every field a string (no type inference).
LAKE_MOVIES_COLUMNS = ["imdbID", "title", "genre", "year", "country", "imdbRating"]
LAKE_USERS_COLUMNS = ["id", "name", "age_group", "country"]
LAKE_RATINGS_COLUMNS = ["id", "user_id", "movie_id", "score", "rated_at"]


def all_string(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


SCORE_TYPE = T.DecimalType(4, 2)
IMDB_RATING_TYPE = T.DecimalType(3, 1)

# Warehouse (schema ``dw``).
DIM_MOVIE = T.StructType([
    T.StructField("movie_id", T.StringType(), False),
    T.StructField("title", T.StringType(), False),
    T.StructField("genre", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("country", T.StringType(), True),
    T.StructField("imdb_rating", IMDB_RATING_TYPE, True),
])

DIM_USER = T.StructType([
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("age_group", T.StringType(), True),
    T.StructField("country", T.StringType(), True),
])

FACT_RATING = T.StructType([
    T.StructField("rating_id", T.LongType(), False),
    T.StructField("movie_id", T.StringType(), False),
    T.StructField("user_id", T.IntegerType(), False),
    T.StructField("score", SCORE_TYPE, True),
    T.StructField("rated_at", T.DateType(), True),
])

# What a load turned away: the lake row, the column and why.
LOAD_REJECTS = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("lake_id", T.StringType(), True),
    T.StructField("file", T.StringType(), True),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("reason", T.StringType(), False),
    T.StructField("raw_value", T.StringType(), True),
])

# Application copy (schema ``public``): same shapes, other key names.
APP_MOVIES = T.StructType([
    T.StructField("imdb_id", T.StringType(), False),
    *DIM_MOVIE.fields[1:],
])
APP_USERS = T.StructType([
    T.StructField("id", T.IntegerType(), False),
    *DIM_USER.fields[1:],
])
APP_RATINGS = T.StructType([
    T.StructField("id", T.LongType(), False),
    *FACT_RATING.fields[1:],
])

WAREHOUSE_TABLES = {
    "dim_movie": DIM_MOVIE,
    "dim_user": DIM_USER,
    "fact_rating": FACT_RATING,
}
