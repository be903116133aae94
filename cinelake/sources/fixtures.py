"""Further inputs derived (in Spark) from the star schema adapters.

Raw lake text, upsert batches, reduced dimensions, selection candidates and
API payloads. Each is a pure function of the test tables and is written
the same way as SQL in ``cinelake.oracle``. Modulus terms only plant
values (bad text, repeats, deletions); they never drop rows to save work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.fixed_values import SEARCH_TERMS
from cinelake.sources.adapters import Star

# Fixed values of the fixtures.
QUOTA_TARGETS = ["ECONOMY", "Brand#1", "SMALL"]
QUOTA = 15
# Positions of repeats: above any key of the tables.
REPEAT_OFFSET = 1_000_000_000_000_000
# The search term (by index) whose paging fails in the last tenth of its pages.
EARLY_STOP_TERM = 2
HITS_PER_PAGE = 10
SEARCH_FAILED = '{"Response":"False","Error":"Movie not found!"}'
SEARCH_EMPTY = '{"Response":"True"}'


def _movie_key(dim_movie: DataFrame) -> F.Column:
    return dim_movie["movie_id"].cast(T.LongType())


def _text(col: str) -> F.Column:
    return F.coalesce(F.col(col).cast(T.StringType()), F.lit(""))


# -- raw lake text --------------------------------------------------------------

def raw_movies(star: Star) -> DataFrame:
    """``movies.csv`` as text: padded titles, unparseable years and ratings,
    missing-value tokens, half-way decimals."""
    k = F.col("movie_id").cast(T.LongType())
    year = (
        F.when(k % 6 == 0, F.lit("2010–2015"))
        .when(k % 6 == 1, F.lit("N/A"))
        .when(k % 12 == 2, F.lit("1999.5"))
        .when(k % 12 == 8, F.lit("1999d"))
        .when(k % 6 == 3, F.lit(" 1999 "))
        .otherwise(_text("year"))
    )
    rating = (
        F.when(k % 8 == 0, F.lit("N/A"))
        .when(k % 8 == 4, F.lit("0x1p3"))
        .when(k % 4 == 1, F.lit("7.85"))
        .when(k % 4 == 2, F.lit("8.05"))
        .otherwise(_text("imdb_rating"))
    )
    return star.dim_movie.select(
        F.col("movie_id").alias("imdbID"),
        F.concat(F.lit("  "), F.col("title"), F.lit(" ")).alias("title"),
        F.when(k % 11 == 0, F.lit("N/A")).otherwise(_text("genre")).alias("genre"),
        year.alias("year"),
        F.when(k % 13 == 0, F.lit("null")).otherwise(_text("country")).alias("country"),
        rating.alias("imdbRating"),
    )


def raw_users(star: Star) -> DataFrame:
    k = F.col("user_id")
    return star.dim_user.select(
        k.cast(T.StringType()).alias("id"),
        F.concat(F.lit(" "), F.col("name"), F.lit("  ")).alias("name"),
        F.when(k % 9 == 0, F.lit("NA")).otherwise(_text("age_group")).alias("age_group"),
        _text("country").alias("country"),
    )


def raw_ratings(star: Star) -> DataFrame:
    k = F.col("rating_id")
    score = (
        F.when(k % 14 == 0, F.lit("abc"))
        .when(k % 14 == 7, F.lit("7.5d"))
        .when(k % 7 == 1, F.lit(""))
        .when(k % 7 == 2, F.lit("nan"))
        .otherwise(_text("score"))
    )
    rated = (
        F.when(k % 5 == 0, F.lit("15/02/2024"))
        .when(k % 5 == 1, F.lit("2024-02-30"))
        .otherwise(_text("rated_at"))
    )
    return star.fact_rating.select(
        k.cast(T.StringType()).alias("id"),
        F.col("user_id").cast(T.StringType()).alias("user_id"),
        F.col("movie_id"),
        score.alias("score"),
        rated.alias("rated_at"),
    )


def quoted_movies(star: Star) -> DataFrame:
    """``raw_movies`` with quotes, commas and line breaks in some titles."""
    k = F.col("imdbID").cast(T.LongType())
    title = (
        F.when(k % 17 == 0, F.concat(F.lit('"'), F.col("title"), F.lit('", part ""2""')))
        .when(k % 41 == 1, F.concat(F.col("title"), F.lit("\nsecond, \"line\"")))
        .otherwise(F.col("title"))
    )
    return raw_movies(star).withColumn("title", title)


def refused_movies(star: Star) -> DataFrame:
    """``raw_movies`` with titles missing and ratings and years out of range."""
    k = F.col("imdbID").cast(T.LongType())
    return raw_movies(star).withColumns({
        "title": F.when(k % 59 == 0, F.lit("N/A")).otherwise(F.col("title")),
        "year": F.when(k % 61 == 0, F.lit("3e9")).otherwise(F.col("year")),
        "imdbRating": F.when(k % 67 == 0, F.lit("-Inf")).when(k % 67 == 1, F.lit("99.95")).otherwise(F.col("imdbRating")),
    })


def refused_users(star: Star) -> DataFrame:
    """``raw_users`` with unusable ids and missing names."""
    k = F.col("id").cast(T.LongType())
    return raw_users(star).withColumns({
        "id": F.when(k % 29 == 0, F.concat(F.lit("u"), F.col("id"))).when(k % 29 == 1, F.concat(F.col("id"), F.lit(".0"))).otherwise(F.col("id")),
        "name": F.when(k % 31 == 0, F.lit("")).otherwise(F.col("name")),
    })


def refused_ratings(star: Star) -> DataFrame:
    """``raw_ratings`` with unusable user ids, titles and scores."""
    k = F.col("id").cast(T.LongType())
    user = (
        F.when(k % 37 == 0, F.lit("null"))
        .when(k % 37 == 1, F.concat(F.col("user_id"), F.lit(".5")))
        .when(k % 37 == 2, F.lit("5e9"))
        .when(k % 37 == 3, F.concat(F.col("user_id"), F.lit("e0")))
        .otherwise(F.col("user_id"))
    )
    return raw_ratings(star).withColumns({
        "user_id": user,
        "movie_id": F.when(k % 43 == 0, F.lit("")).otherwise(F.col("movie_id")),
        "score": F.when(k % 53 == 0, F.lit("inf")).when(k % 53 == 1, F.lit("100")).otherwise(F.col("score")),
    })


# -- reduced dimensions and deletions -------------------------------------------

def dim_movie_partial(star: Star) -> DataFrame:
    return star.dim_movie.where(_movie_key(star.dim_movie) % 19 != 0)


def dim_user_partial(star: Star) -> DataFrame:
    return star.dim_user.where(F.col("user_id") % 19 != 0)


def deleted_movies(star: Star) -> DataFrame:
    return star.dim_movie.where(_movie_key(star.dim_movie) % 19 == 0).select("movie_id")


def deleted_users(star: Star) -> DataFrame:
    return star.dim_user.where(F.col("user_id") % 17 == 0).select("user_id")


# -- violations of declared constraints -------------------------------------------

def violating_tables(star: Star) -> dict[str, DataFrame]:
    """The star's tables with each declared check violated by some rows."""
    mk, uk, rk = F.col("movie_id").cast(T.LongType()), F.col("user_id"), F.col("rating_id")

    def planted(col: str, missing: F.Column | None, long: F.Column | None, size: int = 300) -> F.Column:
        out = F.col(col)
        if long is not None:
            out = F.when(long, F.lit("x" * size)).otherwise(out)
        if missing is not None:
            out = F.when(~F.coalesce(missing, F.lit(False)), out)
        return out.alias(col)

    return {
        "dim_movie": star.dim_movie.select(
            planted("movie_id", mk % 89 == 0, mk % 83 == 1),
            planted("title", mk % 79 == 0, mk % 73 == 1),
            planted("genre", None, mk % 71 == 0),
            planted("country", None, mk % 67 == 0),
        ),
        "dim_user": star.dim_user.select(
            planted("user_id", uk % 61 == 0, None),
            planted("name", uk % 59 == 0, uk % 53 == 1),
            planted("age_group", None, uk % 47 == 0),
            planted("country", None, uk % 43 == 0),
        ),
        "fact_rating": star.fact_rating.select(
            planted("rating_id", rk % 101 == 0, None),
            planted("movie_id", rk % 103 == 0, rk % 107 == 1),
            planted("user_id", rk % 109 == 0, None),
        ),
    }


# -- upsert batches ----------------------------------------------------------------

def upsert_movie_inputs(star: Star) -> tuple[DataFrame, DataFrame]:
    """(base, batch): base holds keys ``% 3 <> 0``; the batch rewrites keys
    ``% 3 <> 1`` (``v1`` titles) and, later in the batch, keys ``% 5 = 0``
    again (``v2`` titles), so the last occurrence must win."""
    d = star.dim_movie
    k = _movie_key(d)
    base = d.where(k % 3 != 0)
    v1 = d.where(k % 3 != 1).withColumn("title", F.concat(F.lit("v1 "), "title")).withColumn("pos", k)
    v2 = d.where(k % 5 == 0).withColumn("title", F.concat(F.lit("v2 "), "title")).withColumn(
        "pos", k + F.lit(REPEAT_OFFSET)
    )
    return base, v1.unionByName(v2)


def upsert_user_inputs(star: Star) -> tuple[DataFrame, DataFrame]:
    d = star.dim_user
    k = F.col("user_id").cast(T.LongType())
    base = d.where(k % 3 != 0)
    v1 = d.where(k % 3 != 1).withColumn("name", F.concat(F.lit("v1 "), "name")).withColumn("pos", k)
    v2 = d.where(k % 5 == 0).withColumn("name", F.concat(F.lit("v2 "), "name")).withColumn(
        "pos", k + F.lit(REPEAT_OFFSET)
    )
    return base, v1.unionByName(v2)


# -- selection candidates ----------------------------------------------------------

def candidates(star: Star) -> DataFrame:
    """Titles in scan order (position = key); keys ``% 7 = 0`` appear again
    later in the scan."""
    d = star.dim_movie
    k = _movie_key(d)
    first = d.select(F.col("movie_id").alias("id"), "title", "genre", k.alias("pos"))
    again = d.where(k % 7 == 0).select(
        F.col("movie_id").alias("id"), "title", "genre", (k + F.lit(REPEAT_OFFSET)).alias("pos")
    )
    return first.unionByName(again)


# -- API payloads ---------------------------------------------------------------------

def search_pages(part: DataFrame) -> DataFrame:
    """One search response per (term, page): ten ids each, some pages ``True``
    without hits. Every term fails after its last page, one of them also in its
    last tenth, so that pages after a failure exist and nearly all are read."""
    k = F.col("p_partkey")
    terms = F.array(*[F.lit(t) for t in SEARCH_TERMS])
    keyed = part.select(
        (k % len(SEARCH_TERMS)).cast("int").alias("ti"),
        (F.expr(f"p_partkey div {len(SEARCH_TERMS) * HITS_PER_PAGE}") + 1).alias("page"),
        F.struct(k.alias("k"), k.cast(T.StringType()).alias("imdbID")).alias("item"),
    )
    # Groups hold one page: at most HITS_PER_PAGE items by construction.
    grouped = keyed.groupBy("ti", "page").agg(F.array_sort(F.collect_list("item")).alias("items"))
    hits = F.transform(F.col("items"), lambda x: F.struct(x["imdbID"].alias("imdbID")))
    full = F.to_json(F.struct(F.lit("True").alias("Response"), hits.alias("Search")))
    # One row per configured term: a bounded side.
    last = keyed.groupBy("ti").agg(F.max("page").alias("last"))
    in_last_tenth = (F.col("ti") == EARLY_STOP_TERM) & (F.col("page") == F.col("last") - F.expr("last div 10"))
    payload = (
        F.when(in_last_tenth, F.lit(SEARCH_FAILED))
        .when((F.col("ti") + F.col("page")) % 11 == 0, F.lit(SEARCH_EMPTY))
        .otherwise(full)
    )
    answered = grouped.join(F.broadcast(last), "ti").select("ti", "page", payload.alias("payload"))
    after = last.select("ti", (F.col("last") + 1).alias("page"), F.lit(SEARCH_FAILED).alias("payload"))
    return answered.unionByName(after).select(
        F.element_at(terms, F.col("ti") + 1).alias("term"), "page", "payload"
    )


def detail_payloads(star: Star) -> DataFrame:
    """One detail response per title; NULL fields are left out of the JSON."""
    d = star.dim_movie
    body = F.struct(
        F.col("title").alias("Title"),
        F.col("genre").alias("Genre"),
        F.col("year").cast(T.StringType()).alias("Year"),
        F.col("country").alias("Country"),
        F.col("imdb_rating").cast(T.StringType()).alias("imdbRating"),
    )
    return d.select(F.col("movie_id").alias("imdbID"), F.to_json(body).alias("payload"))
