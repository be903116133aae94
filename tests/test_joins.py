"""The size-checked broadcast and the shuffle path beyond it agree."""

import pytest

import __spark_entry__ as entry
from cinelake.operators.joins import broadcast_budget, fits_broadcast
from tests.conftest import SF_SMALL

USER_KEYED = ["mart_avg_by_age_group", "mart_ratings_by_country", "mart_country_top10",
              "country_activity", "country_top5", "ratings_known_movies", "orphan_movies",
              "orphan_users", "cascade_delete"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("key", USER_KEYED)
def test_broadcast_and_shuffle_paths_agree(spark, key):
    small = _rows(entry.queries()[key](spark, SF_SMALL))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = _rows(entry.queries()[key](spark, SF_SMALL))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert small == big


def test_fits_broadcast_measures(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) AS s")
    assert fits_broadcast(df, budget=1 << 20)
    assert not fits_broadcast(df, budget=50_000)
    assert not fits_broadcast(df, budget=0)
    assert broadcast_budget(spark) > 0
