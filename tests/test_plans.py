"""Physical-plan assertions: the plans we want, not just the right rows."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from cinelake.operators import sampling
from cinelake.plans import dashboards, marts
from cinelake.registry import REGISTRY
from cinelake.sources import fixtures
from cinelake.sources.adapters import star
from cinelake.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_no_python_udf_in_any_plan(spark, key):
    text = _formatted(entry.queries()[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in text, f"{key} runs Python: {node}"
    assert "REPARTITION" not in text, f"{key} spreads its scan"
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, f"{key} pairs rows without a key: {node}"


def test_top_n_per_genre_uses_window_group_limit(spark):
    text = _formatted(entry.queries()["mart_top10_by_genre"](spark, SF_SMALL))
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize("key", ["popular_titles", "genre_by_primary", "country_activity", "dashboard_top_movies"])
def test_top_k_is_take_ordered(spark, key):
    text = _formatted(entry.queries()[key](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text


def test_columns_are_pruned_at_the_scan(spark):
    text = _formatted(entry.queries()["popular_titles"](spark, SF_SMALL))
    lineitem_scans = [line for line in text.splitlines() if "ReadSchema" in line and "l_orderkey" in line]
    assert lineitem_scans
    for line in lineitem_scans:
        assert "l_extendedprice" not in line and "l_discount" not in line and "l_shipdate" not in line


def test_eager_aggregation_before_dimension_join(spark):
    s = star(spark, SF_SMALL)
    text = _formatted(marts.top_n_per_genre(s.fact_rating, s.dim_movie))
    # The tree lists children below their parents: under the join with the
    # titles, the ratings' side is an aggregate with its partial form below.
    tree = text[: text.index("\n\n\n")] if "\n\n\n" in text else text
    lines = [line for line in tree.splitlines() if re.search(r"\(\d+\)", line)]
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    below = lines[join + 1 :]
    aggregates = [i for i, line in enumerate(below) if "HashAggregate" in line]
    fact_join = next(i for i, line in enumerate(below) if "Join" in line)
    assert len(aggregates) >= 2 and aggregates[1] < fact_join


def test_point_lookup_pushes_to_the_scan(spark, tmp_path):
    s = star(spark, SF_SMALL)
    wh = Warehouse(spark, str(tmp_path / "wh"), "plan_dw")
    wh.create()
    wh.replace("fact_rating", s.fact_rating)
    wh.replace("dim_user", s.dim_user)
    ratings = wh.table("fact_rating").withColumnRenamed("rating_id", "id")
    users = wh.table("dim_user").withColumnRenamed("user_id", "id")
    text = _formatted(dashboards.movie_ratings(ratings, users, "1"))
    assert "PushedFilters: [IsNotNull(movie_id), EqualTo(movie_id,1)" in text


def test_bucketed_dimension_and_skew_safe_fact(spark, tmp_path):
    s = star(spark, SF_SMALL)
    wh = Warehouse(spark, str(tmp_path / "wh"), "plan_bucketed")
    wh.create()
    wh.replace("fact_rating", s.fact_rating)
    wh.replace("dim_movie", s.dim_movie)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = marts.top_n_per_genre(wh.table("fact_rating"), wh.table("dim_movie"))
        text = _formatted(df)
        rows = df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the dimension is read bucketed; the fact is aggregated partially
    # before its only shuffle, which therefore carries per-task sums
    assert "Bucketed: true" in text
    assert "partial_sum" in text
    assert rows > 0


@pytest.mark.parametrize("targets", [3, 10])
def test_quota_cascade_scans_candidates_once(spark, targets):
    names = [f"Brand#{i}" for i in range(targets)]
    rows = sampling.quota_select(fixtures.candidates(star(spark, SF_SMALL)), names, 5)
    text = _formatted(rows)
    # first occurrences and repeats are the two halves of the candidates
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) == 2
