"""Keys that do not depend on how a scan is cut, bucket-wise upserts, rejects,
line breaks through the load."""

import os
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cinelake.operators import clean, keys
from cinelake.operators.integrity import IntegrityError
from cinelake.operators.materialize import materialize
from cinelake.plans.load import LoadPolicy, load_lake
from cinelake.sources import fixtures
from cinelake.sources.adapters import star
from cinelake.sources.lake import POS_FILE, POS_ROW, POS_SPLIT, files_by_line_breaks, read_lake_csv, write_lake_csv
from cinelake.sources.warehouse import GENERATION, PART, Warehouse
from tests.conftest import SF_SMALL

SCAN = ("spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism")


def _cut(spark, size, parallelism):
    for name, value in zip(SCAN, (size, parallelism), strict=True):
        spark.conf.set(name, value)


@pytest.mark.parametrize("place", [POS_ROW, None])
def test_keys_survive_another_cut_of_the_scan(spark, tmp_path, place):
    (tmp_path / "lake").mkdir()
    want = [f"{f}-{i}" for f in range(3) for i in range(20_000)]
    for f in range(3):
        (tmp_path / "lake" / f"part-{f}.csv").write_text("id,v\n" + "".join(f"{f}-{i},x{i % 7}\n" for i in range(20_000)))
    try:
        _cut(spark, 40_000, 4)
        df = read_lake_csv(spark, str(tmp_path / "lake"), with_position=True)
        numbered = keys.number_in_scan_order(df, [POS_FILE, POS_SPLIT], place, name="k")
        _cut(spark, 1 << 20, 16)
        rows = sorted((r.k, r.id) for r in numbered.rows.select("k", "id").collect())
        _cut(spark, 9_000, 1)
        again = sorted((r.k, r.id) for r in numbered.rows.select("k", "id").collect())
    finally:
        for name in SCAN:
            spark.conf.unset(name)
    assert numbered.scanned == len(want) and rows == again == list(enumerate(want, 1))


def test_missing_rows_of_a_split_are_an_error(spark, tmp_path):
    (tmp_path / "r.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(100)))
    df = read_lake_csv(spark, str(tmp_path / "r.csv"), with_position=True)
    with pytest.raises(Exception, match="rows of a file split are missing"):
        keys.dense_index_in_scan_order(df.where("id <> '50'"), [POS_FILE, POS_SPLIT], POS_ROW)
    # A filter is fine where the places are taken behind it.
    kept = keys.dense_index_in_scan_order(df.where("id <> '50'"), [POS_FILE, POS_SPLIT], name="k")
    assert sorted(r.k for r in kept.collect()) == list(range(1, 100))


def test_a_loss_before_the_write_is_an_error(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_loss", buckets=2)
    wh.create()
    fact = star(spark, SF_SMALL).fact_rating
    n = fact.count()
    assert wh.replace("fact_rating", fact, rows=n).rows == n
    version = wh.current_version("fact_rating")
    with pytest.raises(IntegrityError, match=f"rows written of {n} read"):
        wh.replace("fact_rating", fact.where("rating_id % 10 <> 3"), rows=n)
    assert wh.current_version("fact_rating") == version and wh.table("fact_rating").count() == n


def _files(wh, name):
    folder = Path(wh.root) / f"{wh.database}.db" / wh.current_version(name)
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def _movies(spark, rows):
    return spark.createDataFrame(
        [(k, t, "Drama", 2000, None, None, i) for i, (k, t) in enumerate(rows)],
        "movie_id string, title string, genre string, year int, country string, imdb_rating decimal(3,1), pos long",
    )


def test_an_upsert_rewrites_only_the_buckets_it_meets(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_buckets", buckets=16)
    wh.create()
    base = [(f"m{i}", f"t{i}") for i in range(500)]
    wh.upsert("dim_movie", _movies(spark, base), "pos")
    before = _files(wh, "dim_movie")
    batch = [("m1", "old"), ("m1", "new"), ("m7", "seven"), ("fresh", "x")]
    written = wh.upsert("dim_movie", _movies(spark, batch), "pos")
    after = _files(wh, "dim_movie")
    assert 1 <= len(written.parts) <= 3
    assert {f: t for f, t in after.items() if f in before} == before  # nothing rewritten in place
    assert len(after) - len(before) == len(written.parts)
    want = {**dict(base), "m1": "new", "m7": "seven", "fresh": "x"}
    assert {r.movie_id: r.title for r in wh.table("dim_movie").collect()} == want
    assert written.rows < 500 / 16 * 3 * 3
    # A reader lists the current folders only, and still reads buckets.
    scan = wh.table("dim_movie").groupBy("movie_id").count()
    assert "Exchange" not in scan._jdf.queryExecution().executedPlan().toString()
    assert len(wh.table("dim_movie").inputFiles()) >= 16
    # The superseded generations go with the next vacuum.
    wh.vacuum()
    assert len(_files(wh, "dim_movie")) == len(before)
    assert {r.movie_id: r.title for r in wh.table("dim_movie").collect()} == want
    # An empty batch writes nothing; another number of buckets replaces the table.
    assert wh.upsert("dim_movie", _movies(spark, [("a", "b")]).where("pos > 5"), "pos").parts == ()
    other = Warehouse(spark, wh.root, "dw_buckets", buckets=3)
    assert other.upsert("dim_movie", _movies(spark, [("m1", "third")]), "pos").parts is None
    assert {r.movie_id: r.title for r in other.table("dim_movie").collect()} == {**want, "m1": "third"}


def test_a_violating_batch_leaves_no_folder(spark, tmp_path):
    from cinelake.operators.integrity import declared_checks

    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_bad_batch", buckets=4)
    wh.create()
    wh.upsert("dim_movie", _movies(spark, [("a", "b"), ("c", "d")]), "pos")
    version = f"`dw_bad_batch`.`{wh.current_version('dim_movie')}`"
    folders = {r.partition for r in spark.sql(f"SHOW PARTITIONS {version}").collect()}
    with pytest.raises(IntegrityError, match="title_not_null=1"):
        wh.upsert("dim_movie", _movies(spark, [("a", None), ("c", "e")]), "pos", checks=declared_checks(wh.tables["dim_movie"]))
    assert {r.partition for r in spark.sql(f"SHOW PARTITIONS {version}").collect()} == folders
    assert {r.movie_id: r.title for r in wh.table("dim_movie").collect()} == {"a": "b", "c": "d"}
    assert PART in next(iter(folders)) and GENERATION in next(iter(folders))


def test_rejects_are_parted_in_one_scan(spark):
    raw = clean.lake_nulls(materialize(fixtures.refused_ratings(star(spark, SF_SMALL)), "raw-ratings"))
    parsed = clean.parse_ratings(raw, numeric_keys=True)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
    kept, refused = clean.split_rejects(parsed, "test-rejects")
    assert kept.count() + refused.count() == raw.count() and refused.count() > 0
    assert "_rejected" in kept._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    bad = {r.lake_id for r in clean.rejected_columns(refused).collect()}
    strict = clean.clean_ratings(raw.where(~F.col("id").isin(*bad)), numeric_keys=True)
    assert sorted(map(str, strict.select(*kept.drop("lake_id").columns).collect())) == sorted(map(str, kept.drop("lake_id").collect()))


@pytest.mark.parametrize("text, numeric, value, reason", [
    ("7", False, 7, None), ("3.0", True, 3, None), ("3.0", False, None, "not a whole number"), (None, True, None, "missing"),
    ("5e9", True, None, "out of range"), ("99999999999", False, None, "out of range"), ("x", True, None, "not a whole number"),
    (" 8 ", False, 8, None), ("inf", True, None, "not a whole number"), ("", False, None, "not a whole number"),
])
def test_parsed_keys(spark, text, numeric, value, reason):
    from cinelake.functions.scalar import parsed_key

    got = spark.createDataFrame([(text,)], "v string").select(parsed_key("v", numeric).alias("p")).first().p
    assert tuple(got) == (value, reason)


def test_a_load_that_rejects(spark, tmp_path):
    s = star(spark, SF_SMALL)
    lake = str(tmp_path / "lake")
    write_lake_csv(fixtures.raw_movies(s).coalesce(1), f"{lake}/movies.csv")
    write_lake_csv(fixtures.raw_users(s).coalesce(1), f"{lake}/users.csv")
    ratings = fixtures.refused_ratings(s)
    write_lake_csv(ratings.coalesce(2), f"{lake}/ratings.csv")
    with pytest.raises(Exception):
        load_lake(spark, lake, Warehouse(spark, str(tmp_path / "wh1"), "dw_strict"))
    wh = Warehouse(spark, str(tmp_path / "wh2"), "dw_lenient")
    report = load_lake(spark, lake, wh, LoadPolicy(numeric_keys=True, bad_rows="reject"))
    refused = wh.table("load_rejects")
    assert refused.where("table_name <> 'ratings'").count() == 0
    assert {r.reason for r in refused.collect()} == {"missing", "not a whole number", "not a finite number", "out of range"}
    lost = {r.lake_id for r in refused.select("lake_id").collect()}
    assert report.counts["fact_rating"] == ratings.where(~F.col("id").isin(*lost)).count() > 0
    ids = sorted(r.rating_id for r in wh.table("fact_rating").select("rating_id").collect())
    assert ids == list(range(1, len(ids) + 1)) and report.counts["load_rejects"] == refused.count()


def test_line_breaks_go_through_the_load(spark, tmp_path):
    lake = tmp_path / "lake"
    (lake / "movies.csv").mkdir(parents=True)
    head = "imdbID,title,genre,year,country,imdbRating\n"
    (lake / "movies.csv" / "part 0.csv").write_text(head + 'm1,"two\nlines, ""quoted""",Drama,1999,BR,7.5\nm2,plain,"A, B",2000,,N/A\n')
    (lake / "movies.csv" / "part-1.csv").write_text(head + 'm3,"""all""",Drama,x,BR,7.5\nm1,"last\r\nwins\n",Drama,2001,NA,6\n\nm5,e,,,,\n')
    (lake / "movies.csv" / "part-2.csv").write_text(head + "m4,whole,Comedy,2001,US,8.05\n")
    (lake / "users.csv").write_text('id,name,age_group,country\n1,"Ana\nMaria",18-24,BR\n2,Bo,,NA\n')
    (lake / "ratings.csv").write_text("id,user_id,movie_id,score,rated_at\n9,1,m1,7.5,2024-02-15\n8,2,m4,x,2024-02-30\n")
    plain, broken = files_by_line_breaks(spark, str(lake / "movies.csv"))
    assert [os.path.basename(f) for f in plain] == ["part-2.csv"]
    assert [os.path.basename(f) for f in broken] == ["part 0.csv", "part-1.csv"]
    back = read_lake_csv(spark, str(lake / "movies.csv"), multiline=None)
    want = pd.concat([pd.read_csv(f, dtype=str) for f in sorted((lake / "movies.csv").iterdir())])
    want = [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]
    assert sorted(map(tuple, back.collect()), key=str) == sorted(want, key=str)
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_breaks", buckets=2)
    report = load_lake(spark, str(lake), wh)
    assert report.counts == {"dim_movie": 5, "dim_user": 2, "fact_rating": 2}
    titles = {r.movie_id: r.title for r in wh.table("dim_movie").collect()}
    assert titles == {"m1": "last\r\nwins", "m2": "plain", "m3": '"all"', "m4": "whole", "m5": "e"}
    assert {r.name for r in wh.table("dim_user").collect()} == {"Ana\nMaria", "Bo"}


@pytest.mark.parametrize("text", ["2024-02-15", "2024-02-30", "2024-2-5", "15/02/2024", "2024", "2024-02-15T00:00:00", " 2024-02-15", "2024-02-15\n", "", None, "0000-01-01", "99999-01-01"])
def test_dates_parse_as_by_pattern(spark, text):
    from cinelake.functions.scalar import to_lake_date

    df = spark.createDataFrame([(text,)], "v string")
    row = df.select(to_lake_date("v").cast("string").alias("a"), F.try_to_date("v", "yyyy-MM-dd").cast("string").alias("b")).first()
    assert row.a == row.b


def test_pages_read_of_a_term_are_bounded(spark):
    from cinelake.fixed_values import SEARCH_PAGES, SEARCH_TERMS
    from cinelake.plans.acquisition import select_lake_movies

    pages = [(SEARCH_TERMS[0], p, '{"Response":"True","Search":[{"imdbID":"i%d"}]}' % p) for p in range(1, 9)]
    details = spark.createDataFrame([(f"i{p}", '{"Title":"t","Genre":"Action"}') for p in range(1, 9)], "imdbID string, payload string")
    pages = spark.createDataFrame(pages, "term string, page long, payload string")
    got = select_lake_movies(pages, details, ["Action"], 50, max_pages=SEARCH_PAGES).collect()
    assert sorted(r.imdbID for r in got) == [f"i{p}" for p in range(1, SEARCH_PAGES + 1)]


def test_the_copy_in_scan_order_holds_a_place_once(spark, tmp_path, monkeypatch):
    (tmp_path / "r.csv").write_text("id\n" + "".join(f"{i}\n" for i in range(50)))
    df = read_lake_csv(spark, str(tmp_path / "r.csv"), with_position=True)
    kept = []
    whole = keys.materialize_counted
    monkeypatch.setattr(keys, "materialize_counted", lambda rows, name: kept.append(rows.columns) or whole(rows, name))
    assert sorted((r.k, r.id) for r in keys.number_in_scan_order(df, [POS_FILE, POS_SPLIT], POS_ROW, name="k").rows.collect()) == [
        (i + 1, str(i)) for i in range(50)
    ]
    assert kept == [["id", POS_FILE, POS_SPLIT, POS_ROW]]


def test_short_numbers_are_cast_as_through_a_double(spark):
    from cinelake.functions.scalar import _short_decimal, strict_int, to_score
    from cinelake.schemas import SCORE_TYPE

    texts = ["7.85", "0.005", "8.045", "9.994999999", "8.1234567891", "09.5", " 7.5 ", "7.", ".5", "1e0", "7.5d", "+3", "-2.5", "abc", "", None, "99.9"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    through = F.when(F.col("t").rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), F.trim("t").try_cast("double").cast(SCORE_TYPE))
    got = rows.select("t", to_score("t").alias("a"), through.alias("b"), _short_decimal(F.col("t"), SCORE_TYPE).alias("short")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert [r.t for r in got if r.short] == ["7.85", "0.005", "8.045", "9.994999999"]
    whole = spark.createDataFrame([("7",), ("007",), ("999999999",), ("2147483647",), ("3.0",), ("1e2",)], "t string")
    assert [r[0] for r in whole.select(strict_int("t", "t", True)).collect()] == [7, 7, 999999999, 2147483647, 3, 100]
