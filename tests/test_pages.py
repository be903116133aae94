"""Pages built on shared aggregates equal the standalone queries."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from cinelake.plans.pages import analytics_page, front_page
from cinelake.registry import edge
from cinelake.sources.adapters import app_tables, star
from tests.conftest import SF_SMALL


def _rows(df):
    rows = [tuple(r) for r in edge(df).collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_analytics_page_matches_queries(spark):
    s = star(spark, SF_SMALL)
    page = analytics_page(s.fact_rating, s.dim_movie, s.dim_user)
    q = entry.queries()
    assert _rows(page["popular_titles"]) == _rows(q["popular_titles"](spark, SF_SMALL))
    assert _rows(page["genres"]) == _rows(q["genre_by_full_list"](spark, SF_SMALL))
    assert _rows(page["top_by_genre"]) == _rows(q["mart_top10_display"](spark, SF_SMALL))
    age = q["mart_avg_by_age_group"](spark, SF_SMALL).withColumnRenamed("total_ratings", "num_ratings")
    assert _rows(page["by_age_group"]) == _rows(age)
    assert _rows(page["by_country"]) == _rows(q["mart_country_top10"](spark, SF_SMALL))


def test_front_page_matches_queries(spark):
    a = app_tables(spark, SF_SMALL)
    page = front_page(a.movies, a.users, a.ratings)
    q = entry.queries()
    assert _rows(page["top_movies"]) == _rows(q["dashboard_top_movies"](spark, SF_SMALL))
    assert _rows(page["totals"]) == _rows(q["dashboard_totals"](spark, SF_SMALL))
    assert F
