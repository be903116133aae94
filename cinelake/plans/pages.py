"""Whole dashboard pages whose queries share their aggregates.

A page shows several results computed from the same fact. Instead of each
query scanning and aggregating the fact again, the page aggregates it once
— per title (sum, scored count, rating count) and per user — materialises
those sums in the shared folder, and derives every table of the page from
them. Sums and counts re-aggregate exactly, so the results equal the
standalone queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cinelake.fixed_values import TOP_COUNTRIES, TOP_GENRES, TOP_PER_GENRE, TOP_POPULAR
from cinelake.operators import stats
from cinelake.operators.materialize import materialize
from cinelake.plans import analytics, dashboards, marts


def analytics_page(fact: DataFrame, dim_movie: DataFrame, dim_user: DataFrame) -> dict[str, DataFrame]:
    """The analytics page: popular titles, genres, top titles per genre,
    average by age group, activity by country — two fact aggregations in
    total."""
    title_sums = materialize(stats.by_movie(fact), "page-title-sums")
    user_sums = materialize(stats.by_user(fact), "page-user-sums")
    return {
        "popular_titles": analytics.popular(fact, dim_movie, k=TOP_POPULAR, sums=title_sums),
        "genres": analytics.best_genre_lists(fact, dim_movie, k=TOP_GENRES, sums=title_sums),
        "top_by_genre": marts.top_n_display(fact, dim_movie, n=TOP_PER_GENRE, sums=title_sums).drop("rk"),
        "by_age_group": marts.avg_by_age_group(fact, dim_user, user_sums=user_sums).withColumnRenamed(
            "total_ratings", "num_ratings"
        ),
        "by_country": marts.country_top(fact, dim_user, k=TOP_COUNTRIES, user_sums=user_sums),
    }


def front_page(movies: DataFrame, users: DataFrame, ratings: DataFrame) -> dict[str, DataFrame]:
    """The front page: most-rated titles and the four totals, from one
    per-title aggregation of the ratings."""
    title_sums = materialize(stats.by_movie(ratings, rating_id="id"), "page-title-sums")
    top = dashboards.top_rated(movies, ratings, k=TOP_POPULAR, sums=title_sums)
    totals = dashboards.totals_from_sums(movies, users, title_sums)
    return {"top_movies": top, "totals": totals}
