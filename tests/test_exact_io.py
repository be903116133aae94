"""Lake text kept as it is, number and key parsing, positions, honest size
checks, single-pass reference checks, persistent views, clean-up."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cinelake import fixed_values
from cinelake.functions.scalar import strict_int, to_imdb_rating, to_int_truncating, to_score, unicode_strip
from cinelake.operators import keys, sampling
from cinelake.operators.integrity import IntegrityError
from cinelake.operators.joins import fits_broadcast
from cinelake.plans.acquisition import select_lake_movies
from cinelake.plans.load import load_lake
from cinelake.session import checkpoint_dir, staged_scope, staging_path
from cinelake.sources import fixtures
from cinelake.sources.adapters import star
from cinelake.sources.lake import POS_FILE, POS_ROW, POS_SPLIT, read_lake_csv, write_lake_csv
from cinelake.sources.warehouse import Warehouse
from cinelake.streaming.lake_stream import start_ratings_stream
from tests.conftest import SF_SMALL


def _one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column.alias("x")).first().x


def test_csv_keeps_white_space_and_line_breaks(spark, tmp_path):
    rows = [(" Brazil ", 'a "quoted", one'), ("two\nlines", "\tTab ")]
    path = str(tmp_path / "t.csv")
    write_lake_csv(spark.createDataFrame(rows, "country string, title string"), path)
    back = read_lake_csv(spark, path, multiline=True)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


@pytest.mark.parametrize("text", ["inf", "-Infinity", " INF "])
def test_infinity_aborts(spark, text):
    for cast in (to_score, to_imdb_rating):
        with pytest.raises(Exception, match="not a finite number"):
            _one(spark, text, cast("v"))


@pytest.mark.parametrize("text", ["7.5d", "7.5f", "0x1p3", "1999d", "7,5", "", None])
def test_only_plain_numbers_are_numbers(spark, text):
    assert _one(spark, text, to_score("v")) is None
    assert _one(spark, text, to_int_truncating("v")) is None


def test_plain_numbers(spark):
    assert [str(_one(spark, t, to_score("v"))) for t in ("7.85", " 8 ", "1e0", ".5", "+3.")] == ["7.85", "8.00", "1.00", "0.50", "3.00"]


def test_numeric_keys_by_policy(spark):
    for text, value in (("3.0", 3), ("1e2", 100), ("7", 7)):
        assert _one(spark, text, strict_int("v", "user_id", numeric=True)) == value
    for text in ("3.5", "x", "inf", None):
        with pytest.raises(Exception):
            _one(spark, text, strict_int("v", "user_id", numeric=True))
    with pytest.raises(Exception):
        _one(spark, "3.0", strict_int("v", "user_id"))


def test_strip_takes_separators(spark):
    assert _one(spark, "\x1c\x1f  x y \x1e", unicode_strip("v")) == "x y"


def _payloads(spark, hits):
    pages = [(t, p, '{"Response":"True","Search":[{"imdbID":"%s"}]}' % i) for t, p, i in hits]
    details = [(i, '{"Title":"%s","Genre":"Action"}' % i) for _, _, i in hits]
    return (spark.createDataFrame(pages, "term string, page long, payload string"),
            spark.createDataFrame(details, "imdbID string, payload string"))


def test_late_pages_keep_their_term_order_and_other_terms_are_left_out(spark):
    first, second = fixed_values.SEARCH_TERMS[:2]
    pages, details = _payloads(spark, [(first, 1_000_001, "late"), (second, 1, "early"), ("Unlisted", 1, "never")])
    one = select_lake_movies(pages, details, ["Action"], 1).collect()
    assert [r.imdbID for r in one] == ["late"]
    assert sorted(r.imdbID for r in select_lake_movies(pages, details, ["Action"], 5).collect()) == ["early", "late"]


def test_search_pages_are_read_to_the_last_tenth(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    pages = fixtures.search_pages(part)
    failed = pages.where(F.col("payload") == fixtures.SEARCH_FAILED)
    assert failed.groupBy("term").count().where("count > 2").isEmpty()
    assert failed.select("term").distinct().count() == len(fixed_values.SEARCH_TERMS)


@pytest.mark.parametrize("seed", range(3))
def test_cascade_of_ten_targets_equals_a_sequential_scan(spark, seed):
    rng = random.Random(seed)
    targets = [f"g{i}" for i in range(10)]
    cands = [(f"t{i}", " ".join(rng.sample(targets, rng.randint(0, 4))) + " ", p) for p, i in enumerate(rng.choices(range(60), k=90))]
    texts = dict(reversed([(c, t) for c, t, _ in cands]))
    cands = [(c, texts[c], p) for c, _, p in cands]
    seen, counts, want = set(), dict.fromkeys(targets, 0), []
    for cid, text, _ in cands:
        for t in targets if cid not in seen else ():
            if t in text and counts[t] < 3:
                seen.add(cid)
                counts[t] += 1
                want.append((cid, t))
                break
    df = spark.createDataFrame(cands, "id string, genre string, pos int").repartition(3)
    assert sorted((r.id, r.target) for r in sampling.quota_select(df, targets, 3).collect()) == sorted(want)


def test_size_check_sees_new_files(spark, tmp_path):
    path = str(tmp_path / "side")
    spark.range(10).write.parquet(path)
    assert fits_broadcast(spark.read.parquet(path), budget=4096)
    spark.range(200_000).write.mode("overwrite").parquet(path)
    assert not fits_broadcast(spark.read.parquet(path), budget=4096)


def test_scan_order_keys_join_a_broadcast_table_whatever_the_threshold(spark, tmp_path):
    path = str(tmp_path / "r.csv")
    write_lake_csv(spark.range(5000).selectExpr("CAST(id AS STRING) AS id").repartition(6), path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = keys.dense_index_in_scan_order(read_lake_csv(spark, path, with_position=True), [POS_FILE, POS_SPLIT], POS_ROW, name="k")
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted(r.k for r in df.select("k").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert got == list(range(1, 5001))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    d, s = str(tmp_path_factory.mktemp("lake")), star(spark, SF_SMALL)
    write_lake_csv(fixtures.raw_movies(s).coalesce(1), os.path.join(d, "movies.csv"))
    write_lake_csv(fixtures.raw_users(s).coalesce(1), os.path.join(d, "users.csv"))
    write_lake_csv(fixtures.raw_ratings(s).coalesce(2), os.path.join(d, "ratings.csv"))
    return d


def test_views_follow_loads_and_survive_vacuum_and_staging_is_removed(spark, lake, tmp_path):
    folder = os.path.join(checkpoint_dir(spark), "staged").removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_views")
    load_lake(spark, lake, wh)
    first = spark.table("dw_views.mart_ratings_by_country").count()
    load_lake(spark, lake, wh)
    assert wh.vacuum()
    assert spark.table("dw_views.mart_ratings_by_country").count() == first > 0
    assert spark.table("dw_views.mart_top10_by_genre").count() > 0
    assert spark.table("dw_views.mart_avg_by_age_group").count() > 0
    assert (set(os.listdir(folder)) if os.path.isdir(folder) else set()) == before


def test_unknown_keys_drop_the_written_version(spark, lake, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_unknown")
    load_lake(spark, lake, wh)
    version, rows = wh.current_version("fact_rating"), wh.table("fact_rating").count()
    stray = str(tmp_path / "stray")
    for t in ("movies.csv", "users.csv"):
        write_lake_csv(read_lake_csv(spark, f"{lake}/{t}"), f"{stray}/{t}")
    extra = spark.createDataFrame([("1", "1", "no such title", "5", "2024-02-15")], "id string, user_id string, movie_id string, score string, rated_at string")
    write_lake_csv(read_lake_csv(spark, f"{lake}/ratings.csv").unionByName(extra), f"{stray}/ratings.csv")
    with pytest.raises(IntegrityError, match="unknown_movie_id=1"):
        load_lake(spark, stray, wh)
    assert wh.current_version("fact_rating") == version and wh.table("fact_rating").count() == rows


def test_scope_removes_what_was_staged(spark):
    with staged_scope(spark):
        path = staging_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    assert not os.path.exists(path.removeprefix("file:"))


def test_every_planted_violation_is_found(spark):
    from cinelake.registry import REGISTRY

    rows = REGISTRY["violation_report"](spark, SF_SMALL).collect()
    assert rows and all(r.violations > 0 for r in rows), rows


def test_damaged_earlier_rows_stop_the_stream(spark, tmp_path):
    movies, users = spark.createDataFrame([("m1",)], "movie_id string"), spark.createDataFrame([(1,)], "user_id int")
    landing, out = tmp_path / "landing", tmp_path / "fact"
    landing.mkdir()
    (out / "batch_id=0").mkdir(parents=True)
    (out / "batch_id=0" / "part-0.parquet").write_bytes(b"not parquet at all")
    (landing / "a.csv").write_text("id,user_id,movie_id,score,rated_at\n1,1,m1,5,2024-02-15\n")
    query = start_ratings_stream(spark, str(landing), str(out), movies, users, checkpoint_location=str(tmp_path / "ck"))
    with pytest.raises(Exception):
        query.awaitTermination(120)
