"""Star schema derived from the TPC-H-style test tables.

The test data has no movie/user/rating tables, so these adapters map
``part`` → ``dim_movie``, ``customer ⋈ nation`` → ``dim_user`` and
``lineitem ⋈ orders`` → ``fact_rating``. The modulus terms plant the cases
the reference's queries must handle (NULL genres, countries, years and
ratings, NULL scores and dates, unrated titles); none filters rows out. The same mapping is written as SQL in ``cinelake.oracle`` for the DuckDB
cross-check, so both engines read identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TPCH_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# One scan DataFrame per (session, path): listing files and reading the
# parquet footer happen once per session instead of once per query. The
# test tables are immutable; ``forget_tables`` drops the cache otherwise.
_SCANS: dict[tuple[int, str], DataFrame] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table (parquet; projection and filters push down)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _SCANS[key] = spark.read.parquet(path)
    return df


def forget_tables() -> None:
    _SCANS.clear()
    _STARS.clear()


# Column definitions as SQL expressions: one parse per column instead of a
# JVM round trip per operator, which keeps planning cheap.
_DIM_MOVIE = [
    "CAST(p_partkey AS STRING) AS movie_id",
    "p_name AS title",
    """CASE WHEN p_partkey % 31 = 0 THEN CAST(NULL AS STRING)
            WHEN p_partkey % 2 = 0 THEN p_type
            ELSE concat(p_type, ', ', p_brand) END AS genre""",
    "CASE WHEN p_partkey % 37 = 0 THEN CAST(NULL AS INT) ELSE CAST(1950 + p_size AS INT) END AS year",
    "CASE WHEN p_partkey % 43 = 0 THEN CAST(NULL AS STRING) ELSE p_brand END AS country",
    """CASE WHEN p_partkey % 47 = 0 THEN CAST(NULL AS DECIMAL(3,1))
            ELSE CAST(CAST(p_partkey % 101 AS DECIMAL(5,1)) / 10 AS DECIMAL(3,1)) END AS imdb_rating""",
]

_DIM_USER = [
    "CAST(c_custkey AS INT) AS user_id",
    "c_name AS name",
    "CASE WHEN c_custkey % 41 = 0 THEN CAST(NULL AS STRING) ELSE c_mktsegment END AS age_group",
    "CASE WHEN c_nationkey = 13 THEN CAST(NULL AS STRING) ELSE n_name END AS country",
]

_FACT_RATING = [
    "CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS rating_id",
    # Ratings of every positive multiple of 23 go to the title just below it
    # (keys run from 0, so it exists): those titles stay unrated while no
    # rating is dropped.
    "CAST(CASE WHEN l_partkey > 0 AND l_partkey % 23 = 0 THEN l_partkey - 1 ELSE l_partkey END AS STRING) AS movie_id",
    "CAST(o_custkey AS INT) AS user_id",
    """CASE WHEN l_linenumber = 7 OR l_partkey % 29 = 0 THEN CAST(NULL AS DECIMAL(4,2))
            ELSE CAST(CAST(CAST(l_quantity AS INT) * 20 AS DECIMAL(6,2)) / 100 AS DECIMAL(4,2)) END AS score""",
    "CASE WHEN l_suppkey % 53 = 0 THEN CAST(NULL AS DATE) ELSE CAST(l_shipdate AS DATE) END AS rated_at",
]


def dim_movie_from_part(part: DataFrame) -> DataFrame:
    return part.selectExpr(*_DIM_MOVIE)


def dim_user_from_customer(customer: DataFrame, nation: DataFrame) -> DataFrame:
    # ``nation`` has 25 rows by the TPC-H definition: a proven size bound,
    # so it is broadcast and the customer side is never shuffled.
    nat = F.broadcast(nation.select("n_nationkey", "n_name"))
    joined = customer.join(nat, customer["c_nationkey"] == nat["n_nationkey"], "inner")
    return joined.selectExpr(*_DIM_USER)


def fact_rating_from_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    od = orders.select("o_orderkey", "o_custkey")
    joined = lineitem.join(od, lineitem["l_orderkey"] == od["o_orderkey"], "inner")
    return joined.selectExpr(*_FACT_RATING)


class Star:
    """The warehouse star schema (``dw``).

    Built lazily: a query that only needs ``dim_movie`` never plans the
    ``lineitem ⋈ orders`` adapter.
    """

    def __init__(self, dim_movie=None, dim_user=None, fact_rating=None, loader=None):
        self._given = {"dim_movie": dim_movie, "dim_user": dim_user, "fact_rating": fact_rating}
        self._loader = loader
        self._session: SparkSession | None = None

    def _get(self, name: str) -> DataFrame:
        df = self._given.get(name)
        if df is None:
            df = self._loader(name)
            self._given[name] = df
        return df

    @property
    def dim_movie(self) -> DataFrame:
        return self._get("dim_movie")

    @property
    def dim_user(self) -> DataFrame:
        return self._get("dim_user")

    @property
    def fact_rating(self) -> DataFrame:
        return self._get("fact_rating")

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Star":
        t = lambda name: read_table(spark, sf_dir, name)
        builders = {
            "dim_movie": lambda: dim_movie_from_part(t("part")),
            "dim_user": lambda: dim_user_from_customer(t("customer"), t("nation")),
            "fact_rating": lambda: fact_rating_from_lineitem(t("lineitem"), t("orders")),
        }
        return cls(loader=lambda name: builders[name]())

    def app_tables(self) -> "AppTables":
        """The application copy (schema ``public``) with its own key names."""
        star = self
        return AppTables(
            lambda: star.dim_movie.withColumnRenamed("movie_id", "imdb_id"),
            lambda: star.dim_user.withColumnRenamed("user_id", "id"),
            lambda: star.fact_rating.withColumnRenamed("rating_id", "id"),
        )


class AppTables:
    """``movies`` / ``users`` / ``ratings`` of the application schema
    (built on first use)."""

    def __init__(self, movies, users, ratings):
        self._make = {"movies": movies, "users": users, "ratings": ratings}
        self._made: dict[str, DataFrame] = {}

    def _get(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._make[name]()
        return self._made[name]

    @property
    def movies(self) -> DataFrame:
        return self._get("movies")

    @property
    def users(self) -> DataFrame:
        return self._get("users")

    @property
    def ratings(self) -> DataFrame:
        return self._get("ratings")


_STARS: dict[tuple[int, str], Star] = {}


def star(spark: SparkSession, sf_dir: str) -> Star:
    """The (lazily built) star schema over ``sf_dir``; one per session."""
    key = (id(spark), sf_dir.rstrip("/"))
    s = _STARS.get(key)
    if s is None or s._session is not spark:
        s = Star.from_testdata(spark, sf_dir)
        s._session = spark
        _STARS[key] = s
    return s


def app_tables(spark: SparkSession, sf_dir: str) -> AppTables:
    return star(spark, sf_dir).app_tables()
