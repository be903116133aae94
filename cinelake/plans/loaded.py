"""Queries over a loaded warehouse: raw lake text is written as CSV, loaded by
the batch load, and read back through the tables and the persistent views.

Every call loads a lake and a database of its own under the shared folder, so
results stay readable and calls do not meet; both belong to the session's staged
data (see ``session.staged_scope``).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.operators import clean
from cinelake.plans.load import WAREHOUSE_POLICY, LoadPolicy, LoadReport, load_lake
from cinelake.session import staging_path
from cinelake.sources.lake import read_lake_csv, write_lake_csv
from cinelake.sources.warehouse import Warehouse


#: Buckets of a dimension: one per so many rows, and this many more.
ROWS_PER_BUCKET, LEAST_BUCKETS = 1_000_000, 4


def write_raw_lake(spark: SparkSession, movies: DataFrame, users: DataFrame, ratings: DataFrame) -> str:
    """The three lake files, ratings by id, then by their other fields; the lake's folder."""
    lake = staging_path(spark, "lake")
    write_lake_csv(movies, f"{lake}/movies.csv")
    write_lake_csv(users, f"{lake}/users.csv")
    write_lake_csv(ratings.orderBy(F.col("id").cast("long"), "movie_id", "user_id", "score", "rated_at"), f"{lake}/ratings.csv")
    return lake


def new_warehouse(spark: SparkSession, rows: int) -> Warehouse:
    """A database of its own, with buckets for dimensions of this many rows."""
    buckets = LEAST_BUCKETS + rows // ROWS_PER_BUCKET
    return Warehouse(spark, staging_path(spark, "warehouse"), f"cinelake_{uuid.uuid4().hex[:12]}", buckets=buckets)


def load_raw(
    spark: SparkSession,
    movies: DataFrame,
    users: DataFrame,
    ratings: DataFrame,
    loads: int = 1,
    policy: LoadPolicy = WAREHOUSE_POLICY,
) -> tuple[Warehouse, list[LoadReport]]:
    """Write the lake and load it ``loads`` times into a new warehouse."""
    lake = write_raw_lake(spark, movies, users, ratings)
    wh = new_warehouse(spark, max(movies.count(), users.count()))
    return wh, [load_lake(spark, lake, wh, policy) for _ in range(loads)]


def load_report(spark: SparkSession, reports: list[LoadReport]) -> DataFrame:
    """``(run, table_name, rows_loaded)`` as each load reported them."""
    rows = [(run, name, n) for run, report in enumerate(reports, 1) for name, n in report.counts.items()]
    return spark.createDataFrame(rows, "run int, table_name string, rows_loaded long")


def round_trip(spark: SparkSession, movies: DataFrame, users: DataFrame, ratings: DataFrame) -> DataFrame:
    """All rows of the three lake files as read back, without a schema, as text:
    ``(table_name, id, fields)``, fields joined by ``|`` in file order, NULLs as
    ``NULL``."""
    lake = write_raw_lake(spark, movies, users, ratings)
    parts = []
    for name in ("movies", "users", "ratings"):
        back = read_lake_csv(spark, f"{lake}/{name}.csv", multiline=None)
        key, *fields = back.columns
        text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("NULL")) for c in fields])
        parts.append(back.select(F.lit(name).alias("table_name"), F.col(key).alias("id"), text.alias("fields")))
    return reduce(DataFrame.unionByName, parts)


def rejects(movies: DataFrame, users: DataFrame, ratings: DataFrame) -> DataFrame:
    """What a load of these lake rows (missing-value tokens already NULL) turns
    away: ``(table_name, lake_id, column_name, reason, raw_value)``. Accepted and
    rejected rows are parted in one pass over each table."""
    parsed = {
        "movies": clean.parse_movies(movies),
        "users": clean.parse_users(users, numeric_keys=True),
        "ratings": clean.parse_ratings(ratings, numeric_keys=True),
    }
    parts = []
    for name, rows in parsed.items():
        _, refused = clean.split_rejects(rows, f"rejects-{name}")
        parts.append(clean.rejected_columns(refused).select(F.lit(name).alias("table_name"), "lake_id", "column_name", "reason", "raw_value"))
    return reduce(DataFrame.unionByName, parts)
