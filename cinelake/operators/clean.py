"""Cleaning and typing of lake rows (narrow, row-local: no shuffle).

Rules, decided once:
* only ``title`` and ``name`` are stripped (Unicode whitespace);
* ``year`` is coerced leniently: unparseable → NULL, fractions truncated;
* ``imdb_rating`` / ``score`` become exact decimals: unparseable → NULL, but
  an out-of-range value fails the load (the column type would reject it);
* ``rated_at`` is an ISO date, malformed or impossible dates → NULL;
* user ids are strict: missing or non-integer text fails the load;
* a missing genre/country/age group is stored as NULL (optionally as the
  text ``'NaN'``, which is what a float NaN became in the reference's
  database).

``clean_*`` fail a load for what they refuse; ``parse_*`` list it per row and
column instead, and ``split_rejects`` parts the rows in one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.functions.scalar import (
    blank_to_null,
    parsed_decimal,
    parsed_key,
    parsed_text,
    strict_int,
    to_imdb_rating,
    to_int_truncating,
    to_lake_date,
    to_score,
    unicode_strip,
)
from cinelake.schemas import IMDB_RATING_TYPE, SCORE_TYPE
from cinelake.session import staging_path


def _missing(col: str, missing_as_text: str | None, blank_as_null: bool) -> Column:
    c = blank_to_null(col) if blank_as_null else F.col(col)
    if missing_as_text is not None:
        c = F.coalesce(c, F.lit(missing_as_text))
    return c.alias(col)


def clean_movies(
    raw: DataFrame,
    key: str = "movie_id",
    blank_as_null: bool = False,
    missing_as_text: str | None = None,
) -> DataFrame:
    """Lake movies → ``dim_movie`` (``key='movie_id'``) or ``movies``
    (``key='imdb_id'``, with ``blank_as_null=True`` as the app loader does)."""
    df = raw.withColumnsRenamed({"imdbID": key, "imdbRating": "imdb_rating"})
    extra = [c for c in df.columns if c.startswith("_pos_")]
    return df.select(
        F.col(key),
        unicode_strip("title").alias("title"),
        _missing("genre", missing_as_text, blank_as_null),
        to_int_truncating("year").alias("year"),
        _missing("country", missing_as_text, blank_as_null),
        to_imdb_rating("imdb_rating").alias("imdb_rating"),
        *extra,
    )


def clean_users(
    raw: DataFrame,
    key: str = "user_id",
    blank_as_null: bool = False,
    missing_as_text: str | None = None,
    numeric_keys: bool = False,
) -> DataFrame:
    """Lake users → ``dim_user`` (``key='user_id'``) or ``users`` (``key='id'``)."""
    df = raw.withColumnRenamed("id", key) if key != "id" else raw
    extra = [c for c in df.columns if c.startswith("_pos_")]
    return df.select(
        strict_int(key, key, numeric_keys).alias(key),
        unicode_strip("name").alias("name"),
        _missing("age_group", missing_as_text, blank_as_null),
        _missing("country", missing_as_text, blank_as_null),
        *extra,
    )


def clean_ratings(raw: DataFrame, numeric_keys: bool = False) -> DataFrame:
    """Lake ratings → fact rows. The lake's own rating id is dropped: the
    warehouse numbers ratings itself on every full refresh."""
    extra = [c for c in raw.columns if c.startswith("_pos_")]
    return raw.select(
        F.col("movie_id"),
        strict_int("user_id", "user_id", numeric_keys).alias("user_id"),
        to_score("score").alias("score"),
        to_lake_date("rated_at").alias("rated_at"),
        *extra,
    )


# What a row cannot be loaded for: one entry per column that has no value.
REJECTS = "_rejects"
_REJECTED = "_rejected"


def _parsed(raw: DataFrame, parsed: dict[str, tuple[str, Column]], plain: dict[str, Column]) -> DataFrame:
    """Rows with parsed columns (name → lake column and parse result), plain ones
    and the list of what is wrong with them; other columns are left out, except the
    position."""
    extra = [c for c in raw.columns if c.startswith("_pos_")]
    held = raw.select(
        *[c.alias(name) for name, c in plain.items()],
        *[result.alias(f"_parsed_{name}") for name, (_, result) in parsed.items()],
        *[F.col(lake).alias(f"_raw_{name}") for name, (lake, _) in parsed.items()],
        *extra,
    )
    wrong = [
        F.struct(F.lit(lake).alias("column_name"), F.col(f"_parsed_{name}.reason").alias("reason"), F.col(f"_raw_{name}").alias("raw_value"))
        for name, (lake, _) in parsed.items()
    ]
    return held.select(
        *plain,
        *[F.col(f"_parsed_{name}.value").alias(name) for name in parsed],
        *extra,
        F.filter(F.array(*wrong), lambda r: r["reason"].isNotNull()).alias(REJECTS),
    )


def parse_movies(raw: DataFrame, key: str = "movie_id", blank_as_null: bool = False, missing_as_text: str | None = None) -> DataFrame:
    """``clean_movies`` that lists what is wrong with a row instead of failing."""
    must = {
        key: ("imdbID", parsed_text("imdbID")),
        "title": ("title", parsed_text("title", unicode_strip("title"))),
        "year": ("year", parsed_decimal("year", T.IntegerType())),
        "imdb_rating": ("imdbRating", parsed_decimal("imdbRating", IMDB_RATING_TYPE)),
    }
    plain = {c: _missing(c, missing_as_text, blank_as_null) for c in ("genre", "country")}
    return _parsed(raw, must, {"lake_id": F.col("imdbID"), **plain})


def parse_users(
    raw: DataFrame, key: str = "user_id", blank_as_null: bool = False, missing_as_text: str | None = None, numeric_keys: bool = False
) -> DataFrame:
    """``clean_users`` that lists what is wrong with a row instead of failing."""
    must = {key: ("id", parsed_key("id", numeric_keys)), "name": ("name", parsed_text("name", unicode_strip("name")))}
    plain = {c: _missing(c, missing_as_text, blank_as_null) for c in ("age_group", "country")}
    return _parsed(raw, must, {"lake_id": F.col("id"), **plain})


def parse_ratings(raw: DataFrame, numeric_keys: bool = False) -> DataFrame:
    """``clean_ratings`` that lists what is wrong with a row instead of failing."""
    must = {
        "movie_id": ("movie_id", parsed_text("movie_id")),
        "user_id": ("user_id", parsed_key("user_id", numeric_keys)),
        "score": ("score", parsed_decimal("score", SCORE_TYPE)),
    }
    return _parsed(raw, must, {"lake_id": F.col("id"), "rated_at": to_lake_date("rated_at")})


def rejected_columns(parsed: DataFrame) -> DataFrame:
    """One row per column that a row of ``parsed`` is rejected for."""
    extra = [c for c in parsed.columns if c.startswith("_pos_")]
    return parsed.select("lake_id", *extra, F.explode(REJECTS).alias("_r")).select("lake_id", *extra, "_r.*")


def split_rejects(parsed: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (typed) and rejected ones (typed, with the list of reasons).

    One scan writes both sides to the shared folder, each in a partition of its
    own; the two results read only their side.
    """
    spark = parsed.sparkSession
    path = staging_path(spark, name)
    marked = parsed.withColumn(_REJECTED, F.size(REJECTS) > 0)
    marked.write.mode("errorifexists").partitionBy(_REJECTED).parquet(path)
    both = spark.read.schema(marked.schema).parquet(path)
    return both.where(~F.col(_REJECTED)).drop(_REJECTED, REJECTS), both.where(_REJECTED).drop(_REJECTED)


def lake_nulls(raw: DataFrame) -> DataFrame:
    """Missing-value tokens → NULL in every column (the reader's rule)."""
    from cinelake.functions.scalar import na_to_null

    return raw.select(*[na_to_null(c).alias(c) for c in raw.columns])
