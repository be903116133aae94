"""End-to-end load: lake CSV → warehouse → marts; idempotence, upsert,
staged failure, the application policy and reset."""

import os

import pytest
from pyspark.sql import functions as F

from cinelake.operators.integrity import IntegrityError
from cinelake.plans.load import APP_POLICY, app_warehouse, load_lake
from cinelake.sources import fixtures
from cinelake.sources.adapters import star
from cinelake.sources.lake import write_lake_csv
from cinelake.sources.warehouse import Warehouse
from tests.conftest import SF_SMALL


def _write_lake(spark, lake, s):
    write_lake_csv(fixtures.raw_movies(s).coalesce(1), os.path.join(lake, "movies.csv"))
    write_lake_csv(fixtures.raw_users(s).coalesce(1), os.path.join(lake, "users.csv"))
    write_lake_csv(fixtures.raw_ratings(s).coalesce(1), os.path.join(lake, "ratings.csv"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("lake"))
    _write_lake(spark, d, star(spark, SF_SMALL))
    return d


def test_load_twice_gives_equal_tables(spark, lake, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_twice")
    first = load_lake(spark, lake, wh)
    snap = {t: _rows(wh.table(t)) for t in ("dim_movie", "dim_user", "fact_rating")}
    second = load_lake(spark, lake, wh)
    assert first.counts == second.counts
    for t, rows in snap.items():
        assert _rows(wh.table(t)) == rows
    fact = wh.table("fact_rating")
    ids = [r.rating_id for r in fact.orderBy("rating_id").select("rating_id").collect()]
    assert ids == list(range(1, len(ids) + 1))
    assert first.counts["fact_rating"] == len(ids)
    assert spark.table(f"{wh.database}.mart_top10_by_genre").count() > 0


def test_upsert_updates_and_keeps(spark, lake, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_upsert")
    load_lake(spark, lake, wh)
    before = {r.movie_id: r.title for r in wh.table("dim_movie").collect()}
    lake2 = str(tmp_path / "lake2")
    movies = spark.read.option("header", True).csv(os.path.join(lake, "movies.csv"))
    changed = movies.where(F.col("imdbID").cast("long") % 2 == 0).withColumn("title", F.lit("renamed"))
    write_lake_csv(changed.coalesce(1), os.path.join(lake2, "movies.csv"))
    for t in ("users.csv", "ratings.csv"):
        spark.read.option("header", True).csv(os.path.join(lake, t)).coalesce(1).write.option(
            "header", True).option("escape", '"').csv(os.path.join(lake2, t))
    load_lake(spark, lake2, wh)
    after = {r.movie_id: r.title for r in wh.table("dim_movie").collect()}
    assert set(after) == set(before)
    assert all(after[k] == "renamed" for k in after if int(k) % 2 == 0)
    assert all(after[k] == before[k] for k in after if int(k) % 2 == 1)


def test_failed_load_leaves_previous_version(spark, lake, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_fail")
    load_lake(spark, lake, wh)
    fact_before = _rows(wh.table("fact_rating"))
    bad = str(tmp_path / "bad")
    for t in ("movies.csv", "users.csv"):
        spark.read.option("header", True).csv(os.path.join(lake, t)).coalesce(1).write.option(
            "header", True).option("escape", '"').csv(os.path.join(bad, t))
    ratings = spark.read.option("header", True).csv(os.path.join(lake, "ratings.csv"))
    broken = ratings.withColumn("user_id", F.when(F.col("id").cast("long") % 10 == 3, F.lit("x"))
                                .otherwise(F.col("user_id")))
    broken.coalesce(1).write.option("header", True).option("escape", '"').csv(os.path.join(bad, "ratings.csv"))
    with pytest.raises(Exception):
        load_lake(spark, bad, wh)
    assert _rows(wh.table("fact_rating")) == fact_before


def test_orphan_policies(spark, lake, tmp_path):
    part = str(tmp_path / "partial")
    movies = spark.read.option("header", True).csv(os.path.join(lake, "movies.csv"))
    movies.where(F.col("imdbID").cast("long") % 19 != 0).coalesce(1).write.option("header", True).option(
        "escape", '"').csv(os.path.join(part, "movies.csv"))
    for t in ("users.csv", "ratings.csv"):
        spark.read.option("header", True).csv(os.path.join(lake, t)).coalesce(1).write.option(
            "header", True).option("escape", '"').csv(os.path.join(part, t))
    with pytest.raises(IntegrityError):
        load_lake(spark, part, Warehouse(spark, str(tmp_path / "wh1"), "dw_orphans"))
    app = app_warehouse(spark, str(tmp_path / "wh2"))
    report = load_lake(spark, part, app, APP_POLICY)
    ratings = app.table("ratings")
    assert ratings.where(F.col("movie_id").cast("long") % 19 == 0).isEmpty()
    ids = [r.id for r in ratings.orderBy("id").select("id").collect()]
    assert ids == list(range(1, report.counts["ratings"] + 1))


def test_reset_only_our_database(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_reset")
    wh.create()
    wh.replace("dim_user", star(spark, SF_SMALL).dim_user)
    assert wh.table("dim_user").count() > 0
    wh.reset()
    assert wh.table("dim_user").count() == 0
    spark.sql("CREATE DATABASE IF NOT EXISTS foreign_db")
    with pytest.raises(PermissionError):
        Warehouse(spark, str(tmp_path / "wh"), "foreign_db").reset()


def test_command_line_load_and_report(spark, lake, tmp_path, capsys):
    from cinelake.__main__ import main

    root = str(tmp_path / "cli")
    assert main(["load", "--lake", lake, "--root", root]) == 0
    counts = capsys.readouterr().out.strip().splitlines()[-1]
    assert '"fact_rating"' in counts
    assert main(["report", "--root", root]) == 0
    out = capsys.readouterr().out
    assert "== popular_titles" in out and "== best_genres" in out and "== active_countries" in out


def test_generated_lake_loads_end_to_end(spark, tmp_path):
    from cinelake.plans.acquisition import generate_lake, select_lake_movies, write_lake

    s = star(spark, SF_SMALL)
    movies = select_lake_movies(
        fixtures.search_pages(s.dim_movie.sparkSession.read.parquet(f"{SF_SMALL}/part.parquet")),
        fixtures.detail_payloads(s), fixtures.QUOTA_TARGETS, fixtures.QUOTA)
    lake_movies, lake_users, lake_ratings = generate_lake(movies, s.dim_user)
    out = str(tmp_path / "generated")
    write_lake(out, lake_movies.coalesce(1), lake_users.coalesce(1), lake_ratings.coalesce(1))
    n_movies, n_users = lake_movies.count(), lake_users.count()
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_generated")
    report = load_lake(spark, out, wh)
    assert report.counts["dim_movie"] == n_movies
    assert report.counts["dim_user"] == n_users
    assert report.counts["fact_rating"] == n_users * min(5, n_movies)
    per_user = wh.table("fact_rating").groupBy("user_id").agg(F.countDistinct("movie_id").alias("m"))
    assert per_user.where(F.col("m") != min(5, n_movies)).isEmpty()
    assert spark.table(f"{wh.database}.mart_top10_by_genre").count() > 0


def test_vacuum_drops_old_versions(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_vacuum")
    wh.create()
    s = star(spark, SF_SMALL)
    for _ in range(3):
        wh.replace("dim_user", s.dim_user)
    versions = [t.name for t in spark.catalog.listTables("dw_vacuum") if t.name.startswith("dim_user__v")]
    assert len(versions) == 4  # the empty first version + three loads
    current = wh.current_version("dim_user")
    dropped = wh.vacuum(keep=1)
    left = [t.name for t in spark.catalog.listTables("dw_vacuum") if t.name.startswith("dim_user__v")]
    assert left == [current] and len([d for d in dropped if d.startswith("dim_user__v")]) == 3
    assert wh.table("dim_user").count() == s.dim_user.count()
    files = list((tmp_path / "wh" / "dw_vacuum.db").iterdir())
    assert sorted(p.name for p in files if p.name.startswith("dim_user__v")) == [current]


def test_declared_violation_keeps_previous_dimension(spark, lake, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_declared")
    load_lake(spark, lake, wh)
    before = _rows(wh.table("dim_movie"))
    versions_before = {t.name for t in spark.catalog.listTables("dw_declared")}
    bad = str(tmp_path / "bad")
    movies = spark.read.option("header", True).csv(os.path.join(lake, "movies.csv"))
    movies.withColumn("title", F.when(F.col("imdbID") == "1", F.lit(None)).otherwise(F.col("title"))).coalesce(
        1).write.option("header", True).option("escape", '"').csv(os.path.join(bad, "movies.csv"))
    for t in ("users.csv", "ratings.csv"):
        spark.read.option("header", True).csv(os.path.join(lake, t)).coalesce(1).write.option(
            "header", True).option("escape", '"').csv(os.path.join(bad, t))
    with pytest.raises(IntegrityError, match="title_not_null=1"):
        load_lake(spark, bad, wh)
    assert _rows(wh.table("dim_movie")) == before
    assert {t.name for t in spark.catalog.listTables("dw_declared")} == versions_before
