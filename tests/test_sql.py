"""The SQL surface equals the DataFrame functions."""

from cinelake.plans import analytics, marts
from cinelake.plans import sql as sqlsurface
from cinelake.sources.adapters import star
from tests.conftest import SF_SMALL


def _rows(df):
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_sql_marts_and_reports_equal_dataframes(spark):
    s = star(spark, SF_SMALL)
    sqlsurface.register_star(spark, s.fact_rating, s.dim_movie, s.dim_user)
    sqlsurface.create_mart_views(spark)
    assert _rows(spark.table("mart_top10_by_genre")) == _rows(
        marts.top_n_per_genre(s.fact_rating, s.dim_movie).drop("rk"))
    assert _rows(spark.table("mart_avg_by_age_group")) == _rows(marts.avg_by_age_group(s.fact_rating, s.dim_user))
    assert _rows(spark.table("mart_ratings_by_country")) == _rows(
        marts.ratings_by_country(s.fact_rating, s.dim_user))
    assert _rows(sqlsurface.report(spark, "popular_titles")) == _rows(analytics.popular(s.fact_rating, s.dim_movie))
    assert _rows(sqlsurface.report(spark, "best_genres")) == _rows(analytics.best_genres(s.fact_rating, s.dim_movie))
    assert _rows(sqlsurface.report(spark, "active_countries")) == _rows(
        analytics.countries(s.fact_rating, s.dim_user))
