"""Incremental ingest of title, user and rating files landing in the lake.

The reference reloads the whole ratings file on every run. When rating
files keep landing, the same cleaning, reference checks and lake-order
numbering can run per micro-batch instead:

* source: Structured Streaming file source over the landing folder, every
  field read as text (fixed schema, no inference);
* per micro-batch (``foreachBatch``): missing-value tokens → NULL, typing,
  strict user ids, foreign-key check against the dimensions (a batch with
  an unknown title or user fails), rating ids continuing from the last
  committed batch, numbered in lake order (file, split, row);
* ratings sink: one ``batch_id=<n>`` partition per micro-batch, written with
  dynamic partition overwrite. A replayed batch rewrites exactly its own
  partition, and its ids only depend on earlier batches, so a retry after a
  failure gives the same table: exactly-once together with the checkpoint;
* title and user files (``start_dimension_stream``) are upserted into the
  warehouse per micro-batch, last row per key winning in lake order.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cinelake.functions.scalar import na_to_null
from cinelake.operators import clean, integrity, keys
from cinelake.schemas import LAKE_RATINGS_COLUMNS, all_string
from cinelake.session import checkpoint_dir, path_exists, staged_scope
from cinelake.sources.lake import POS_FILE, POS_ROW, POS_SPLIT

BATCH_COL = "batch_id"


def _committed_rows(spark: SparkSession, out_dir: str, batch_id: int) -> int:
    """Rows written by batches before ``batch_id`` (0 if nothing was written yet;
    earlier rows that cannot be read are an error).

    Ids are dense from 1, so this is also the largest id so far. A row
    count prunes to the earlier ``batch_id`` partitions and is answered
    from parquet footers, without reading any column data.
    """
    if not path_exists(spark, out_dir):
        return 0
    prior = spark.read.parquet(out_dir)
    return prior.where(F.col(BATCH_COL) < batch_id).count()


def ratings_batch(
    batch: DataFrame,
    dim_movie: DataFrame,
    dim_user: DataFrame,
    start: int,
    key: str = "rating_id",
) -> keys.Numbered:
    """Clean, check and number one micro-batch of raw rating rows.

    ``batch`` carries the file and split columns selected at the streaming
    scan; the row position is taken right on top of it. Nothing is filtered
    out afterwards (unknown keys fail the batch), so the per-split numbering
    stays dense.
    """
    raw = batch.select(
        *[na_to_null(c).alias(c) for c in LAKE_RATINGS_COLUMNS],
        F.col(POS_FILE),
        F.col(POS_SPLIT),
        F.monotonically_increasing_id().alias(POS_ROW),
    )
    ratings = clean.clean_ratings(raw)
    ratings = integrity.enforce_references(ratings, dim_movie, "movie_id", "fail")
    ratings = integrity.enforce_references(ratings, dim_user, "user_id", "fail")
    numbered = keys.number_in_scan_order(ratings, [POS_FILE, POS_SPLIT], POS_ROW, name=key, start=start)
    return keys.Numbered(numbered.rows.select(key, "movie_id", "user_id", "score", "rated_at"), numbered.scanned)


def start_ratings_stream(
    spark: SparkSession,
    landing_dir: str,
    out_dir: str,
    dim_movie: DataFrame | Callable[[], DataFrame],
    dim_user: DataFrame | Callable[[], DataFrame],
    checkpoint_location: str | None = None,
    available_now: bool = True,
    key: str = "rating_id",
    multiline: bool = False,
) -> StreamingQuery:
    """Start the incremental ingest; returns the running query. ``multiline``:
    landed files may hold quoted line breaks and are read whole.

    The dimensions may be given as callables (e.g. ``lambda:
    wh.table("dim_movie")``) so every micro-batch checks against the
    versions current at that batch.
    """
    ckpt = checkpoint_location or os.path.join(checkpoint_dir(spark), "streams", "ratings")
    source = (
        spark.readStream.schema(all_string(LAKE_RATINGS_COLUMNS))
        .option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        .csv(landing_dir)
        .select(
            *LAKE_RATINGS_COLUMNS,
            F.col("_metadata.file_path").alias(POS_FILE),
            F.col("_metadata.file_block_start").alias(POS_SPLIT),
        )
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        start = _committed_rows(batch.sparkSession, out_dir, batch_id) + 1
        movies = dim_movie() if callable(dim_movie) else dim_movie
        users = dim_user() if callable(dim_user) else dim_user
        with staged_scope(batch.sparkSession):
            numbered = ratings_batch(batch, movies, users, start, key)
            written = Observation()
            out = numbered.rows.withColumn(BATCH_COL, F.lit(batch_id)).observe(written, F.count(F.lit(1)).alias("rows"))
            (
                out.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BATCH_COL)
                .parquet(out_dir)
            )
        if written.get["rows"] != numbered.scanned:  # the batch is not committed; its replay overwrites it
            raise integrity.IntegrityError(f"batch {batch_id}: {written.get['rows']} rows written of {numbered.scanned} read")

    writer = source.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def start_dimension_stream(
    spark: SparkSession,
    landing_dir: str,
    wh,
    table: str = "dim_movie",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    multiline: bool = False,
) -> StreamingQuery:
    """Incremental upsert of landed title or user files into ``wh``.

    Each micro-batch is cleaned like the batch load, checked against the
    declared constraints, and upserted (last row per key wins, in lake
    order; absent keys are kept) through a staged version switch. Replaying
    a batch upserts the same rows again, which leaves the table unchanged.
    """
    from cinelake.schemas import DIM_MOVIE, DIM_USER, LAKE_MOVIES_COLUMNS, LAKE_USERS_COLUMNS
    if table == "dim_movie":
        columns, schema, cleaner = LAKE_MOVIES_COLUMNS, DIM_MOVIE, clean.clean_movies
    elif table == "dim_user":
        columns, schema, cleaner = LAKE_USERS_COLUMNS, DIM_USER, clean.clean_users
    else:
        raise ValueError(f"not a dimension: {table}")
    ckpt = checkpoint_location or os.path.join(checkpoint_dir(spark), "streams", table)
    source = (
        spark.readStream.schema(all_string(columns))
        .option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("multiLine", multiline)
        .csv(landing_dir)
        .select(
            *columns,
            F.col("_metadata.file_path").alias(POS_FILE),
            F.col("_metadata.file_block_start").alias(POS_SPLIT),
        )
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        raw = batch.select(
            *[na_to_null(c).alias(c) for c in columns],
            F.col(POS_FILE),
            F.col(POS_SPLIT),
            F.monotonically_increasing_id().alias(POS_ROW),
        )
        rows = cleaner(raw)
        rows = rows.withColumn("_pos", F.struct(POS_FILE, POS_SPLIT, POS_ROW)).drop(POS_FILE, POS_SPLIT, POS_ROW)
        # Declared constraints are counted while the touched buckets are written.
        with staged_scope(batch.sparkSession):
            wh.upsert(table, rows, "_pos", checks=integrity.declared_checks(schema))

    wh.create()
    writer = source.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
