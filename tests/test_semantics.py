"""Hand-made frames for the semantic traps: rounding, NULL order, grouping
keys, outer-join counts, tie-breaks, missing-value tokens, whitespace,
strict keys and decimal overflow."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cinelake.functions.scalar import NA_TOKENS, avg_of, first_genre, or_placeholder, unicode_strip
from cinelake.operators import clean
from cinelake.plans import analytics, dashboards, marts

MOVIE_SCHEMA = "movie_id string, title string, genre string, year int, country string, imdb_rating decimal(3,1)"
FACT_SCHEMA = "rating_id long, movie_id string, user_id int, score decimal(4,2), rated_at date"
USER_SCHEMA = "user_id int, name string, age_group string, country string"


def _fact(spark, rows):
    return spark.createDataFrame(
        [(i + 1, m, u, None if s is None else Decimal(s), None) for i, (m, u, s) in enumerate(rows)], FACT_SCHEMA
    )


def test_average_rounds_once(spark):
    # 10,001 × 7.44 and 10,000 × 7.45: true mean 7.44499975 → 7.44.
    # Spark's avg(decimal(4,2)) keeps 6 digits (7.445000) and then rounds
    # to 7.45: the trap the exact ratio avoids.
    rows = [(Decimal("7.44"),)] * 10001 + [(Decimal("7.45"),)] * 10000
    df = spark.createDataFrame(rows, "score decimal(4,2)")
    got = df.agg(avg_of("score").alias("a"), F.round(F.avg("score"), 2).alias("naive")).first()
    assert got.a == Decimal("7.44")
    assert got.naive == Decimal("7.45")


def test_all_null_title_ranks_first_and_keeps_count(spark):
    movies = spark.createDataFrame(
        [("a", "A", "Drama", None, None, None), ("b", "B", "Drama", None, None, None)], MOVIE_SCHEMA
    )
    fact = _fact(spark, [("a", 1, "9.00"), ("b", 1, None), ("b", 2, None)])
    rows = marts.top_n_per_genre(fact, movies, 10).collect()
    assert [r.movie_id for r in rows] == ["b", "a"]
    assert rows[0].avg_score is None and rows[0].total_ratings == 2


def test_same_title_different_ids_stay_apart(spark):
    movies = spark.createDataFrame(
        [("a", "Twin", "Drama", None, None, None), ("b", "Twin", "Drama", None, None, None)], MOVIE_SCHEMA
    )
    fact = _fact(spark, [("a", 1, "5.00"), ("b", 1, "6.00"), ("b", 2, "7.00")])
    rows = analytics.popular(fact, movies, k=5).collect()
    assert [(r.title, r.total_ratings) for r in rows] == [("Twin", 2), ("Twin", 1)]


def test_primary_genre_vs_full_list(spark):
    movies = spark.createDataFrame(
        [("a", "A", "Action, Drama", None, None, None), ("b", "B", "Action, Comedy", None, None, None)],
        MOVIE_SCHEMA,
    )
    fact = _fact(spark, [("a", 1, "8.00"), ("b", 1, "6.00")])
    by_primary = analytics.best_genres(fact, movies).collect()
    assert [(r.primary_genre, r.total_ratings, r.avg_score) for r in by_primary] == [("Action", 2, Decimal("7.00"))]
    by_list = analytics.best_genre_lists(fact, movies).collect()
    assert [(r.genre, r.num_ratings) for r in by_list] == [("Action", 1), ("Action", 1)]


def test_blank_genre_is_a_group_null_is_filtered(spark):
    movies = spark.createDataFrame(
        [("a", "A", "", None, None, None), ("b", "B", None, None, None, None)], MOVIE_SCHEMA
    )
    fact = _fact(spark, [("a", 1, "8.00"), ("b", 1, "6.00")])
    rows = analytics.best_genres(fact, movies).collect()
    assert [(r.primary_genre, r.total_ratings) for r in rows] == [("", 1)]
    assert spark.range(1).select(first_genre(F.lit("")).alias("g")).first().g == ""


def test_unrated_title_in_catalog(spark):
    movies = spark.createDataFrame(
        [("a", "A", "Drama", 2000, "X", Decimal("7.5")), ("b", "B", None, None, None, None)],
        MOVIE_SCHEMA.replace("movie_id", "imdb_id"),
    )
    ratings = _fact(spark, [("a", 1, "8.00")]).withColumnRenamed("rating_id", "id")
    rows = {r.imdb_id: r for r in dashboards.catalog(movies, ratings).collect()}
    assert rows["b"].num_ratings == 0 and rows["b"].avg_score is None
    assert rows["a"].num_ratings == 1 and rows["a"].avg_score == Decimal("8.00")


def test_ties_broken_by_key(spark):
    movies = spark.createDataFrame(
        [(k, "T", "Drama", None, None, None) for k in ["c", "a", "b"]], MOVIE_SCHEMA
    )
    fact = _fact(spark, [("c", 1, "5.00"), ("a", 1, "5.00"), ("b", 1, "5.00")])
    rows = marts.top_n_per_genre(fact, movies, 2).collect()
    assert [r.movie_id for r in rows] == ["a", "b"]
    top = analytics.popular(fact, movies.withColumn("title", F.col("movie_id")), k=2).collect()
    assert [r.title for r in top] == ["a", "b"]


def test_null_order_desc_first_asc_last(spark):
    users = spark.createDataFrame([(1, "u1", "18-24", "BR"), (2, "u2", "25-34", "BR")], USER_SCHEMA)
    fact = _fact(spark, [("a", 1, None), ("a", 2, "9.00")])
    rows = marts.avg_by_age_group(fact, users).collect()
    assert [r.age_group for r in rows] == ["18-24", "25-34"]  # NULL average first


def test_all_na_tokens_become_null(spark):
    df = spark.createDataFrame([(t,) for t in NA_TOKENS] + [("ok",), (" NA",)], "v string")
    out = [r.v for r in clean.lake_nulls(df).collect()]
    assert out[: len(NA_TOKENS)] == [None] * len(NA_TOKENS)
    assert out[len(NA_TOKENS):] == ["ok", " NA"]


def test_unicode_strip_only_on_titles(spark):
    df = spark.createDataFrame([("\t Title  ",)], "t string")
    assert df.select(unicode_strip("t").alias("t")).first().t == "Title"
    assert df.select(F.trim("t").alias("t")).first().t != "Title"


def test_numeric_coercion_rules(spark):
    raw = spark.createDataFrame(
        [("m1", " T ", "G", "1999.5", "C", "7.85"), ("m2", "T", None, "2010–2015", None, "8.05"),
         ("m3", "T", "", " 1999 ", "", "x")],
        "imdbID string, title string, genre string, year string, country string, imdbRating string",
    )
    rows = {r.movie_id: r for r in clean.clean_movies(raw).collect()}
    assert rows["m1"].year == 1999 and rows["m1"].imdb_rating == Decimal("7.9")
    assert rows["m2"].year is None and rows["m2"].imdb_rating == Decimal("8.1")
    assert rows["m3"].year == 1999 and rows["m3"].imdb_rating is None
    assert rows["m1"].title == "T"
    app = {r.imdb_id: r for r in clean.clean_movies(raw, key="imdb_id", blank_as_null=True).collect()}
    assert app["m3"].genre is None and rows["m3"].genre == ""
    text = {r.movie_id: r for r in clean.clean_movies(raw, missing_as_text="NaN").collect()}
    assert text["m2"].genre == "NaN"


def test_dates_iso_only(spark):
    raw = spark.createDataFrame(
        [("m", "1", "7.5", "2024-02-15"), ("m", "2", "", "15/02/2024"), ("m", "3", "abc", "2024-02-30")],
        "movie_id string, user_id string, score string, rated_at string",
    )
    rows = clean.clean_ratings(raw).orderBy("user_id").collect()
    assert [r.rated_at for r in rows] == [dt.date(2024, 2, 15), None, None]
    assert [r.score for r in rows] == [Decimal("7.50"), None, None]


@pytest.mark.parametrize(
    "rating,user",
    [("123.4", "1"), ("7.0", "x"), ("7.0", None)],
)
def test_strict_values_fail_the_load(spark, rating, user):
    raw = spark.createDataFrame([("m", user, rating, "2024-02-15")],
                                "movie_id string, user_id string, score string, rated_at string")
    with pytest.raises(Exception):
        clean.clean_ratings(raw).collect()


def test_placeholders(spark):
    df = spark.createDataFrame(
        [(None, 0, Decimal("0.0"), "")], "g string, y int, r decimal(3,1), c string"
    )
    r = df.select(*[or_placeholder(c).alias(c) for c in df.columns]).first()
    assert tuple(r) == ("–", "–", "–", "–")
    keep = spark.createDataFrame([("0",)], "g string").select(or_placeholder("g", zero_is_missing=False).alias("g"))
    assert keep.first().g == "0"


def test_movie_stats_one_row_for_unknown_title(spark):
    ratings = _fact(spark, [("a", 1, "8.00")]).withColumnRenamed("rating_id", "id")
    r = dashboards.movie_stats(ratings, "nope").collect()
    assert len(r) == 1 and r[0].total == 0 and r[0].avg is None
    assert dashboards.movie(ratings.withColumnRenamed("movie_id", "imdb_id"), "nope").isEmpty()


def test_split_rejects_keeps_good_rows(spark):
    raw = spark.createDataFrame([("1",), ("x",), (None,), ("2",)], "user_id string")
    ok, bad = clean.split_rejects(raw, "user_id")
    assert sorted(r.user_id for r in ok.collect()) == ["1", "2"]
    assert sorted((r.user_id or "") for r in bad.collect()) == ["", "x"]


def test_declared_checks_and_uniqueness(spark):
    from cinelake.operators import integrity
    from cinelake.schemas import DIM_MOVIE

    good = spark.createDataFrame([("m1", "T", None, None, None, None)], MOVIE_SCHEMA)
    integrity.enforce_declared(good, "dim_movie", DIM_MOVIE)
    bad = spark.createDataFrame(
        [("m1", None, None, None, None, None), ("x" * 21, "T", None, None, None, None)], MOVIE_SCHEMA
    )
    with pytest.raises(integrity.IntegrityError, match="title_not_null=1.*movie_id_length=1|movie_id_length=1.*title_not_null=1"):
        integrity.enforce_declared(bad, "dim_movie", DIM_MOVIE)
    integrity.assert_unique(good, "movie_id")
    with pytest.raises(integrity.IntegrityError):
        integrity.assert_unique(good.unionByName(good), "movie_id")


def test_full_refresh_twice_is_equal(spark):
    from cinelake.operators.upsert import full_refresh

    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    first = sorted(tuple(r) for r in full_refresh(spark, rows, "t").collect())
    second = sorted(tuple(r) for r in full_refresh(spark, rows, "t").collect())
    assert first == second == [(1, "a"), (2, "b")]
