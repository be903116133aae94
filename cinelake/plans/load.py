"""The batch load: lake → cleaned, checked dimensions and fact → marts.

Order as in the reference: schema, movies, users, ratings, mart views.
Two policies reproduce the reference's two loaders:

* warehouse (``dw``): ratings with an unknown movie or user fail the load;
* application (``app``): ratings with an unknown movie are dropped, blank
  texts become NULL, unknown users still fail.

Unlike the reference, the fact is never left truncated by a failed load:
the new version is written completely before the table switches to it.
Dimensions are upserted (last row per key wins, absent keys survive);
the fact is fully refreshed with ratings numbered 1..N in lake order.
Violations are counted with ``Observation`` while the rows are written; row
counts come from the footers of the written version.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.operators import clean, integrity, keys
from cinelake.plans import sql
from cinelake.schemas import (
    APP_MOVIES,
    APP_USERS,
    DIM_MOVIE,
    DIM_USER,
    LAKE_MOVIES_COLUMNS,
    LAKE_RATINGS_COLUMNS,
    LAKE_USERS_COLUMNS,
    LOAD_REJECTS,
)
from cinelake.session import staged_scope
from cinelake.sources.lake import POS_FILE, POS_ROW, POS_SPLIT, read_lake_csv
from cinelake.sources.warehouse import APP_TABLES, Warehouse


@dataclass(frozen=True)
class LoadPolicy:
    movie_key: str = "movie_id"
    user_key: str = "user_id"
    rating_key: str = "rating_id"
    movies_table: str = "dim_movie"
    users_table: str = "dim_user"
    ratings_table: str = "fact_rating"
    orphan_movies: str = "fail"
    orphan_users: str = "fail"
    blank_as_null: bool = False
    missing_as_text: str | None = None
    numeric_keys: bool = False
    # "fail": a row that cannot be typed fails the load; "reject": it goes to
    # the table of rejects, with the column and the reason.
    bad_rows: str = "fail"


REJECTS_TABLE = "load_rejects"

WAREHOUSE_POLICY = LoadPolicy(numeric_keys=True)
APP_POLICY = LoadPolicy(
    movie_key="imdb_id",
    user_key="id",
    rating_key="id",
    movies_table="movies",
    users_table="users",
    ratings_table="ratings",
    orphan_movies="drop",
    orphan_users="fail",
    blank_as_null=True,
)


@dataclass
class LoadReport:
    counts: dict[str, int] = field(default_factory=dict)


def _position() -> F.Column:
    # Lake order: file, then split start inside the file, then row in split.
    return F.struct(F.col(POS_FILE), F.col(POS_SPLIT), F.col(POS_ROW))


def _upsert_dimension(wh: Warehouse, table: str, cleaned: DataFrame, schema, report: LoadReport) -> None:
    batch = cleaned.withColumn("_pos", _position()).drop(POS_FILE, POS_SPLIT, POS_ROW)
    # Declared constraints are counted while the touched buckets are written; a
    # violation discards them before the switch.
    wh.upsert(table, batch, "_pos", checks=integrity.declared_checks(schema))
    report.counts[table] = wh.table(table).count()  # answered from the footers


def load_lake(
    spark: SparkSession,
    lake_dir: str,
    wh: Warehouse,
    policy: LoadPolicy = WAREHOUSE_POLICY,
    register_views: bool = True,
) -> LoadReport:
    """Run the whole load; returns the row count of every written table."""
    with staged_scope(spark):
        return _load(spark, lake_dir, wh, policy, register_views)


def _load(
    spark: SparkSession, lake_dir: str, wh: Warehouse, policy: LoadPolicy, register_views: bool
) -> LoadReport:
    report = LoadReport()
    lake = lake_dir.rstrip("/")
    rejected: list[DataFrame] = []
    if policy.bad_rows not in ("fail", "reject"):
        raise ValueError(f"unknown policy {policy.bad_rows!r}")
    if policy.bad_rows == "reject":
        wh.tables.setdefault(REJECTS_TABLE, LOAD_REJECTS)
    wh.create()

    def read(table: str, columns: list[str]) -> DataFrame:
        # Files that hold quoted line breaks are found and read whole.
        return read_lake_csv(spark, f"{lake}/{table}.csv", columns, with_position=True, multiline=None)

    def accepted(table: str, parsed: DataFrame) -> DataFrame:
        kept, refused = clean.split_rejects(parsed, f"load-{table}")
        refused = clean.rejected_columns(refused).select(
            F.lit(table).alias("table_name"), "lake_id", F.col(POS_FILE).alias("file"), "column_name", "reason", "raw_value"
        )
        rejected.append(refused)
        return kept.drop("lake_id")

    texts = {"blank_as_null": policy.blank_as_null, "missing_as_text": policy.missing_as_text}
    reject = policy.bad_rows == "reject"

    # -- movies (upsert) ---------------------------------------------------------------
    raw_movies = read("movies", LAKE_MOVIES_COLUMNS)
    if reject:
        movies = accepted("movies", clean.parse_movies(raw_movies, policy.movie_key, **texts))
    else:
        movies = clean.clean_movies(raw_movies, policy.movie_key, **texts)
    movie_schema = DIM_MOVIE if policy.movie_key == "movie_id" else APP_MOVIES
    _upsert_dimension(wh, policy.movies_table, movies, movie_schema, report)

    # -- users (upsert) ----------------------------------------------------------------
    raw_users = read("users", LAKE_USERS_COLUMNS)
    if reject:
        users = accepted("users", clean.parse_users(raw_users, policy.user_key, numeric_keys=policy.numeric_keys, **texts))
    else:
        users = clean.clean_users(raw_users, policy.user_key, numeric_keys=policy.numeric_keys, **texts)
    user_schema = DIM_USER if policy.user_key == "user_id" else APP_USERS
    _upsert_dimension(wh, policy.users_table, users, user_schema, report)

    # -- ratings (full refresh, numbered in lake order) ----------------------------------
    raw_ratings = read("ratings", LAKE_RATINGS_COLUMNS)
    if reject:
        ratings = accepted("ratings", clean.parse_ratings(raw_ratings, policy.numeric_keys))
    else:
        ratings = clean.clean_ratings(raw_ratings, numeric_keys=policy.numeric_keys)
    references = [
        ("movie_id", wh.table(policy.movies_table), policy.movie_key, policy.orphan_movies),
        ("user_id", wh.table(policy.users_table), policy.user_key, policy.orphan_users),
    ]
    for key, dim, dim_key, orphans in references:
        if orphans == "drop":
            ratings = integrity.keep_known(ratings, dim, key, dim_key)
    if reject or "drop" in (policy.orphan_movies, policy.orphan_users):
        # Rows may have been removed after the scan: number the survivors
        # with the sort-based dense index over the lake position.
        numbered = keys.number_in_order(ratings, [F.col(POS_FILE), F.col(POS_SPLIT), F.col(POS_ROW)],
                                        name=policy.rating_key)
    else:
        # Nothing was removed since the scan: splits are still contiguous,
        # so only the per-split table needs ordering.
        numbered = keys.number_in_scan_order(ratings, [POS_FILE, POS_SPLIT], POS_ROW, name=policy.rating_key)
    # Unknown keys and declared constraints are counted in the pass that writes.
    checks = integrity.declared_checks(wh.tables[policy.ratings_table])
    rows = numbered.rows
    for key, dim, dim_key, orphans in references:
        if orphans == "fail":
            rows, check = integrity.with_reference(rows, dim, key, dim_key)
            checks.append(check)
    # As many rows must be written as were numbered.
    wh.replace(policy.ratings_table, rows, checks=checks, rows=numbered.scanned)
    report.counts[policy.ratings_table] = wh.table(policy.ratings_table).count()

    # -- rejects ---------------------------------------------------------------------
    if reject:
        turned_away = reduce(DataFrame.unionByName, rejected)
        report.counts[REJECTS_TABLE] = wh.replace(REJECTS_TABLE, turned_away).rows

    # -- marts ----------------------------------------------------------------------
    if register_views and policy.movies_table == "dim_movie":
        sql.create_mart_views(spark, wh.database)
    return report


def warehouse(spark: SparkSession, root: str) -> Warehouse:
    return Warehouse(spark, root, "dw")


def app_warehouse(spark: SparkSession, root: str) -> Warehouse:
    return Warehouse(spark, root, "app", APP_TABLES)
