"""Named queries: ``name → (spark, sf_dir) → DataFrame``.

Each entry builds its inputs from the test tables (via the adapters), calls
the public plan function, and converts exact decimals to doubles at the
edge — the only place where that happens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.fixed_values import (
    TOP_COUNTRIES,
    TOP_COUNTRIES_SHORT,
    TOP_GENRES,
    TOP_GENRES_SHORT,
    TOP_PER_GENRE,
    TOP_POPULAR,
)
from cinelake.operators import clean, integrity, keys, sampling, upsert
from cinelake.oracle import DETAIL_MOVIE_ID
from cinelake.plans import acquisition, analytics, dashboards, display, loaded, marts
from cinelake.schemas import DIM_MOVIE, DIM_USER, FACT_RATING
from cinelake.sources import fixtures, payloads
from cinelake.sources.adapters import app_tables, read_table, star

Query = Callable[[SparkSession, str], DataFrame]


def edge(df: DataFrame) -> DataFrame:
    """Cast decimal columns to double for the cross-engine comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(df[f.name].cast(T.DoubleType()).alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return edge(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run

    return deco


# -- dashboards ---------------------------------------------------------------

@register("dashboard_top_movies")
def _dashboard_top_movies(spark, sf):
    a = app_tables(spark, sf)
    return dashboards.top_rated(a.movies, a.ratings, k=TOP_POPULAR)


@register("dashboard_totals")
def _dashboard_totals(spark, sf):
    a = app_tables(spark, sf)
    return dashboards.totals(a.movies, a.users, a.ratings)


@register("catalog")
def _catalog(spark, sf):
    a = app_tables(spark, sf)
    return dashboards.catalog(a.movies, a.ratings)


@register("movie_record")
def _movie_record(spark, sf):
    return dashboards.movie(app_tables(spark, sf).movies, DETAIL_MOVIE_ID)


@register("movie_ratings")
def _movie_ratings(spark, sf):
    a = app_tables(spark, sf)
    return dashboards.movie_ratings(a.ratings, a.users, DETAIL_MOVIE_ID)


@register("movie_stats")
def _movie_stats(spark, sf):
    return dashboards.movie_stats(app_tables(spark, sf).ratings, DETAIL_MOVIE_ID)


# -- analytics ----------------------------------------------------------------

@register("popular_titles")
def _popular_titles(spark, sf):
    s = star(spark, sf)
    return analytics.popular(s.fact_rating, s.dim_movie, k=TOP_POPULAR)


@register("popular_titles_short")
def _popular_titles_short(spark, sf):
    s = star(spark, sf)
    return analytics.popular(s.fact_rating, s.dim_movie, k=TOP_POPULAR, with_genre=False)


@register("genre_by_primary")
def _genre_by_primary(spark, sf):
    s = star(spark, sf)
    return analytics.best_genres(s.fact_rating, s.dim_movie, k=TOP_GENRES)


@register("genre_by_primary_top5")
def _genre_by_primary_top5(spark, sf):
    s = star(spark, sf)
    return analytics.best_genres(s.fact_rating, s.dim_movie, k=TOP_GENRES_SHORT)


@register("genre_by_full_list")
def _genre_by_full_list(spark, sf):
    s = star(spark, sf)
    return analytics.best_genre_lists(s.fact_rating, s.dim_movie, k=TOP_GENRES)


@register("country_activity")
def _country_activity(spark, sf):
    s = star(spark, sf)
    return analytics.countries(s.fact_rating, s.dim_user, k=TOP_COUNTRIES)


@register("country_top5")
def _country_top5(spark, sf):
    s = star(spark, sf)
    return analytics.countries(s.fact_rating, s.dim_user, k=TOP_COUNTRIES_SHORT, distinct=False)


# -- marts ----------------------------------------------------------------------

@register("mart_top10_by_genre")
def _mart_top10_by_genre(spark, sf):
    s = star(spark, sf)
    return marts.top_n_per_genre(s.fact_rating, s.dim_movie, n=TOP_PER_GENRE).drop("rk")


@register("mart_top10_display")
def _mart_top10_display(spark, sf):
    s = star(spark, sf)
    return marts.top_n_display(s.fact_rating, s.dim_movie, n=TOP_PER_GENRE).drop("rk")


@register("mart_avg_by_age_group")
def _mart_avg_by_age_group(spark, sf):
    s = star(spark, sf)
    return marts.avg_by_age_group(s.fact_rating, s.dim_user)


@register("mart_ratings_by_country")
def _mart_ratings_by_country(spark, sf):
    s = star(spark, sf)
    return marts.ratings_by_country(s.fact_rating, s.dim_user)


@register("mart_country_top10")
def _mart_country_top10(spark, sf):
    s = star(spark, sf)
    return marts.country_top(s.fact_rating, s.dim_user, k=TOP_COUNTRIES)


# -- cleaning -------------------------------------------------------------------

@register("clean_movies")
def _clean_movies(spark, sf):
    return clean.clean_movies(clean.lake_nulls(fixtures.raw_movies(star(spark, sf))))


@register("clean_users")
def _clean_users(spark, sf):
    return clean.clean_users(clean.lake_nulls(fixtures.raw_users(star(spark, sf))))


@register("clean_ratings")
def _clean_ratings(spark, sf):
    return clean.clean_ratings(clean.lake_nulls(fixtures.raw_ratings(star(spark, sf))))


@register("na_tokens")
def _na_tokens(spark, sf):
    s = star(spark, sf)
    out = None
    for name, raw in (
        ("movies", fixtures.raw_movies(s)),
        ("users", fixtures.raw_users(s)),
        ("ratings", fixtures.raw_ratings(s)),
    ):
        nulls = clean.lake_nulls(raw)
        checks = [integrity.Check(c, F.col(c).isNull()) for c in nulls.columns]
        part = integrity.violation_counts(nulls, name, checks).withColumnsRenamed(
            {"check_name": "column_name", "violations": "missing"}
        )
        out = part if out is None else out.unionByName(part)
    return out


@register("violation_report")
def _violation_report(spark, sf):
    tables = fixtures.violating_tables(star(spark, sf))
    schemas = {"dim_movie": DIM_MOVIE, "dim_user": DIM_USER, "fact_rating": FACT_RATING}
    return integrity.violation_report({name: (df, schemas[name]) for name, df in tables.items()})


@register("duplicate_keys")
def _duplicate_keys(spark, sf):
    return integrity.duplicate_keys(star(spark, sf).fact_rating, "rating_id")


# -- referential integrity ---------------------------------------------------------

@register("ratings_known_movies")
def _ratings_known_movies(spark, sf):
    s = star(spark, sf)
    return integrity.keep_known(s.fact_rating, fixtures.dim_movie_partial(s), "movie_id")


@register("orphan_movies")
def _orphan_movies(spark, sf):
    s = star(spark, sf)
    return integrity.orphans(s.fact_rating, fixtures.dim_movie_partial(s), "movie_id")


@register("orphan_users")
def _orphan_users(spark, sf):
    s = star(spark, sf)
    return integrity.orphans(s.fact_rating, fixtures.dim_user_partial(s), "user_id")


@register("cascade_delete")
def _cascade_delete(spark, sf):
    s = star(spark, sf)
    return integrity.cascade_delete(
        s.fact_rating, {"movie_id": fixtures.deleted_movies(s), "user_id": fixtures.deleted_users(s)}
    )


# -- loads ------------------------------------------------------------------------------

@register("upsert_dim_movie")
def _upsert_dim_movie(spark, sf):
    base, batch = fixtures.upsert_movie_inputs(star(spark, sf))
    return upsert.upsert(base, batch, "movie_id", "pos")


@register("upsert_dim_user")
def _upsert_dim_user(spark, sf):
    base, batch = fixtures.upsert_user_inputs(star(spark, sf))
    return upsert.upsert(base, batch, "user_id", "pos")


@register("refresh_fact")
def _refresh_fact(spark, sf):
    raw = clean.lake_nulls(fixtures.raw_ratings(star(spark, sf)))
    cleaned = clean.clean_ratings(raw.withColumn("_pos_lake_id", F.col("id").cast("long")))
    keyed = keys.dense_index(
        cleaned,
        [
            F.col("_pos_lake_id").asc_nulls_first(),
            F.col("movie_id").asc_nulls_first(),
            F.col("user_id").asc_nulls_first(),
            F.col("score").asc_nulls_first(),
            F.col("rated_at").asc_nulls_first(),
        ],
        name="rating_id",
    )
    return keyed.select("rating_id", "movie_id", "user_id", "score", "rated_at")


@register("surrogate_keys")
def _surrogate_keys(spark, sf):
    d = star(spark, sf).dim_movie.select("movie_id", "title", F.col("movie_id").cast("long").alias("_k"))
    keyed = keys.dense_index(d, [F.col("_k").asc()], name="id")
    return keyed.select("id", F.col("movie_id").alias("imdb_id"), "title")


@register("load_counts")
def _load_counts(spark, sf):
    s = star(spark, sf)
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows_loaded")).select(F.lit(name).alias("table_name"), "rows_loaded")
        for name, df in (("dim_movie", s.dim_movie), ("dim_user", s.dim_user), ("fact_rating", s.fact_rating))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- loaded warehouse -----------------------------------------------------------------

def _raw(spark, sf):
    s = star(spark, sf)
    return fixtures.raw_movies(s), fixtures.raw_users(s), fixtures.raw_ratings(s)


@register("lake_round_trip")
def _lake_round_trip(spark, sf):
    s = star(spark, sf)
    return loaded.round_trip(spark, fixtures.quoted_movies(s), fixtures.raw_users(s), fixtures.raw_ratings(s))


@register("load_rejects")
def _load_rejects(spark, sf):
    s = star(spark, sf)
    raw = (fixtures.refused_movies(s), fixtures.refused_users(s), fixtures.refused_ratings(s))
    return loaded.rejects(*[clean.lake_nulls(df) for df in raw])


@register("loaded_counts")
def _loaded_counts(spark, sf):
    return loaded.load_report(spark, loaded.load_raw(spark, *_raw(spark, sf), loads=2)[1])


@register("loaded_fact")
def _loaded_fact(spark, sf):
    return loaded.load_raw(spark, *_raw(spark, sf), loads=2)[0].table("fact_rating")


@register("loaded_dim_movie")
def _loaded_dim_movie(spark, sf):
    base, batch = fixtures.upsert_movie_inputs(star(spark, sf))
    wh = loaded.new_warehouse(spark, base.count())
    wh.create()
    wh.replace("dim_movie", base)
    wh.upsert("dim_movie", batch, "pos")
    return wh.table("dim_movie")


def _view(name: str) -> Query:
    def run(spark, sf):
        wh, _ = loaded.load_raw(spark, *_raw(spark, sf))
        return spark.table(f"`{wh.database}`.`{name}`")

    return run


register("view_top10_by_genre")(_view("mart_top10_by_genre"))
register("view_avg_by_age_group")(_view("mart_avg_by_age_group"))
register("view_ratings_by_country")(_view("mart_ratings_by_country"))


# -- JSON payloads ------------------------------------------------------------------------

@register("search_hits")
def _search_hits(spark, sf):
    return payloads.search_hits(fixtures.search_pages(read_table(spark, sf, "part")))


@register("detail_projection")
def _detail_projection(spark, sf):
    return payloads.detail_projection(fixtures.detail_payloads(star(spark, sf)))


# -- selection and sampling ------------------------------------------------------------------

def _quota(spark, sf):
    return sampling.quota_select(
        fixtures.candidates(star(spark, sf)), fixtures.QUOTA_TARGETS, fixtures.QUOTA
    )


@register("quota_selection")
def _quota_selection(spark, sf):
    return _quota(spark, sf)


@register("quota_counts")
def _quota_counts(spark, sf):
    return sampling.quota_counts(_quota(spark, sf), fixtures.QUOTA_TARGETS)


@register("dedupe_first")
def _dedupe_first(spark, sf):
    return sampling.dedupe_first(fixtures.candidates(star(spark, sf)), "id", "pos")


def _pairs(spark, sf):
    s = star(spark, sf)
    return sampling.sample_k(s.dim_user, s.dim_movie, "user_id", "movie_id", k=sampling.RATINGS_PER_USER)


@register("sample_k_per_user")
def _sample_k_per_user(spark, sf):
    return _pairs(spark, sf)


@register("assign_categories")
def _assign_categories(spark, sf):
    return sampling.assign_categories(star(spark, sf).dim_user, "user_id")


@register("synthetic_scores")
def _synthetic_scores(spark, sf):
    return sampling.synthetic_scores(_pairs(spark, sf).select("user_id", "movie_id"), ["user_id", "movie_id"])


# -- display --------------------------------------------------------------------------------

@register("display_rank")
def _display_rank(spark, sf):
    s = star(spark, sf)
    return display.ranked_popular(s.fact_rating, s.dim_movie, k=TOP_POPULAR)


@register("genre_headers")
def _genre_headers(spark, sf):
    s = star(spark, sf)
    return display.genre_headers(s.fact_rating, s.dim_movie, n=TOP_PER_GENRE)


@register("display_placeholders")
def _display_placeholders(spark, sf):
    a = app_tables(spark, sf)
    return display.catalog_display(a.movies, a.ratings)


@register("primary_genre_badge")
def _primary_genre_badge(spark, sf):
    s = star(spark, sf)
    return display.popular_badges(s.fact_rating, s.dim_movie, k=TOP_POPULAR)


@register("stats_if_rated")
def _stats_if_rated(spark, sf):
    a = app_tables(spark, sf)
    return display.stats_if_rated(a.movies, a.ratings)


@register("catalog_size")
def _catalog_size(spark, sf):
    return display.catalog_size(app_tables(spark, sf).movies)


# -- lake acquisition -----------------------------------------------------------------------

@register("lake_movie_selection")
def _lake_movie_selection(spark, sf):
    s = star(spark, sf)
    return acquisition.select_lake_movies(
        fixtures.search_pages(read_table(spark, sf, "part")),
        fixtures.detail_payloads(s),
        fixtures.QUOTA_TARGETS,
        fixtures.QUOTA,
    )
