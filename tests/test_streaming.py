"""Incremental rating ingest: two landings, ids continue, replay-safe."""

import os

from pyspark.sql import functions as F

from cinelake.streaming.lake_stream import start_ratings_stream


def _land(path, rows):
    with open(path, "w") as f:
        f.write("id,user_id,movie_id,score,rated_at\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_two_landings_number_densely(spark, tmp_path):
    movies = spark.createDataFrame([("m1",), ("m2",)], "movie_id string")
    users = spark.createDataFrame([(1,), (2,)], "user_id int")
    landing = tmp_path / "landing"
    landing.mkdir()
    out = str(tmp_path / "fact")
    ckpt = str(tmp_path / "ckpt")
    _land(landing / "a.csv", [("9", "1", "m1", "7.5", "2024-02-15"), ("8", "2", "m2", "N/A", "bad")])
    q = start_ratings_stream(spark, str(landing), out, movies, users, checkpoint_location=ckpt)
    q.awaitTermination(120)
    _land(landing / "b.csv", [("7", "2", "m1", "3.0", "2024-02-16")])
    q = start_ratings_stream(spark, str(landing), out, movies, users, checkpoint_location=ckpt)
    q.awaitTermination(120)
    rows = spark.read.parquet(out).orderBy("rating_id").collect()
    assert [r.rating_id for r in rows] == [1, 2, 3]
    assert [(r.movie_id, r.user_id) for r in rows] == [("m1", 1), ("m2", 2), ("m1", 2)]
    assert rows[1].score is None and rows[1].rated_at is None
    assert sorted({r.batch_id for r in rows}) == [0, 1]
    assert os.path.isdir(ckpt)
    assert F


def test_dimension_stream_upserts(spark, tmp_path):
    from cinelake.sources.warehouse import Warehouse
    from cinelake.streaming.lake_stream import start_dimension_stream

    landing = tmp_path / "movies"
    landing.mkdir()
    wh = Warehouse(spark, str(tmp_path / "wh"), "dw_stream")
    ckpt = str(tmp_path / "ckpt-movies")
    with open(landing / "a.csv", "w") as f:
        f.write("imdbID,title,genre,year,country,imdbRating\n")
        f.write("m1, First ,Drama,1999,BR,7.5\nm2,Second,,N/A,,x\n")
    start_dimension_stream(spark, str(landing), wh, "dim_movie", checkpoint_location=ckpt).awaitTermination(120)
    with open(landing / "b.csv", "w") as f:
        f.write("imdbID,title,genre,year,country,imdbRating\n")
        f.write("m2,Second v2,Comedy,2001,US,8.05\nm3,Third,Action,2010,FR,6.0\n")
    start_dimension_stream(spark, str(landing), wh, "dim_movie", checkpoint_location=ckpt).awaitTermination(120)
    rows = {r.movie_id: r for r in wh.table("dim_movie").collect()}
    assert sorted(rows) == ["m1", "m2", "m3"]
    assert rows["m1"].title == "First" and rows["m2"].title == "Second v2"
    assert str(rows["m2"].imdb_rating) == "8.1" and rows["m2"].year == 2001
