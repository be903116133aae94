"""Warehouse tables in the Spark catalog, written as versioned tables behind
a stable view.

Every load writes the next version of a table as its own managed parquet
table (inside the database folder under the shared root) and only then
points the public name — a view, which records its current version — at it.
``vacuum`` drops versions no view uses any more, and with them their files. Readers never see a
half-written table, a failed load leaves the previous version in place, and
a plan that reads the current version can produce the next one without
overwriting its own input.

A batch that updates a dimension rewrites only the buckets it meets. A
dimension's version holds one bucket per folder, in generations
(``_part=<bucket>/_gen=<generation>``): ``upsert`` adds a generation of the
touched buckets beside the old ones, and the view, which names the current
generation of every bucket, is switched after the write. Its filter is on
partition columns, so a reader lists only current folders and still finds the
table bucketed.

Dimensions are bucketed on their unique keys (``dim_movie`` on
``movie_id``, ``dim_user`` on ``user_id``), so joins against them never
shuffle the dimension side; rows are repartitioned on the key before the
write so each bucket is one file. The fact is deliberately not bucketed on
a dimension key: a title or user holding a third of all ratings would make
one bucket — one write task and one scan task — hold a third of the fact.
Its queries aggregate partially per task before any shuffle instead, which
collapses such a key.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.operators.integrity import Check, IntegrityError
from cinelake.operators.materialize import materialize
from cinelake.operators.upsert import latest_per_key, upsert
from cinelake.schemas import APP_MOVIES, APP_RATINGS, APP_USERS, WAREHOUSE_TABLES

ENGINE_TAG = "cinelake"

APP_TABLES = {"movies": APP_MOVIES, "users": APP_USERS, "ratings": APP_RATINGS}

# Bucket (and sort) key of every dimension: its unique key. Facts are not
# bucketed (see above).
BUCKET_KEYS = {
    "dim_movie": "movie_id",
    "dim_user": "user_id",
    "movies": "imdb_id",
    "users": "id",
}


# Partition columns of a dimension's version: bucket and generation.
PART, GENERATION = "_part", "_gen"
# Generations are kept in view properties of at most this many characters.
_PROPERTY_CHARS = 3000


@dataclass(frozen=True)
class Written:
    """What a write did: the version table it went to, the rows observed on
    their way into it, and the buckets it wrote (None: all of the table)."""

    version: str
    rows: int
    parts: tuple[int, ...] | None = None


class Warehouse:
    """A database of versioned parquet tables (dimensions bucketed) rooted at
    ``root``.

    ``root`` must be a folder every executor can reach (on a cluster, the
    shared storage the job writes to). ``buckets`` defaults to the session's
    shuffle partition count; tables joined together must use the same.
    """

    def __init__(self, spark: SparkSession, root: str, database: str = "dw",
                 tables: dict[str, T.StructType] | None = None, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.database = database
        self.tables = dict(tables if tables is not None else WAREHOUSE_TABLES)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # -- schema ----------------------------------------------------------------------

    def create(self) -> None:
        """``CREATE SCHEMA/TABLE IF NOT EXISTS`` (idempotent). New tables
        start as an empty version so they can be read right away."""
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.database}` "
            f"LOCATION '{self.root}/{self.database}.db' "
            f"WITH DBPROPERTIES ('created_by'='{ENGINE_TAG}')"
        )
        for name, schema in self.tables.items():
            if not self.spark.catalog.tableExists(f"{self.database}.{name}"):
                self.replace(name, self.spark.createDataFrame([], schema))

    def reset(self) -> None:
        """Drop the database (only one this engine created) and recreate it."""
        if self.spark.catalog.databaseExists(self.database):
            props = {
                r.info_name: r.info_value
                for r in self.spark.sql(f"DESCRIBE DATABASE EXTENDED `{self.database}`").collect()
            }
            if f"(created_by,{ENGINE_TAG})" not in props.get("Properties", ""):
                raise PermissionError(f"database {self.database} was not created by {ENGINE_TAG}")
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        self.create()

    # -- reads and writes ----------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def replace(self, name: str, df: DataFrame, checks: Sequence[Check] = (), rows: int | None = None) -> Written:
        """Staged full replacement of table ``name`` by ``df``.

        ``df`` is written completely as a new version table; then the view
        ``name`` is switched to it.

        ``checks`` are counted with an ``Observation`` while the version is
        written — no extra pass — and so are its rows. A violation, or another
        number of rows than ``rows`` (what the caller read), drops the new version
        and raises before the switch, leaving the table as it was.
        """
        # Version names sort by creation time (then a random suffix).
        version = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
        generations = [0] * self.buckets if name in BUCKET_KEYS else []
        observed = self._write(name, version, df, checks, generation=0)
        try:
            self._verify(name, observed, rows)
        except IntegrityError:
            self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{version}`")
            raise
        self._switch(name, version, generations)
        return Written(version, observed["rows"])

    def upsert(self, name: str, batch: DataFrame, position: str, checks: Sequence[Check] = ()) -> Written:
        """Update dimension ``name`` by ``batch`` (its columns and ``position``):
        the last row per key wins, absent keys are kept.

        Only the buckets that hold a key of the batch are read and written again,
        as a new generation beside the old one; a violation drops it and raises.
        A version with another number of buckets is replaced as a whole.
        """
        key, version, generations = BUCKET_KEYS[name], *self._state(name)
        cols = [f.name for f in self.tables[name].fields]
        if len(generations) != self.buckets:
            return self.replace(name, upsert(self.table(name), batch, key, position), checks)
        # Written once: the touched buckets and the merge both read it.
        latest = materialize(latest_per_key(batch.select(*cols, position), key, position), f"upsert-{name}")
        met = latest.select(self._part(key).alias(PART)).distinct()
        parts = tuple(sorted(r[0] for r in met.collect()))  # at most one row per bucket
        if not parts:
            return Written(version, 0, parts)
        current = self.spark.table(f"`{self.database}`.`{version}`").where(self._is_current(generations))
        base = current.where(F.col(PART).isin(*parts)).select(*cols)
        merged = base.join(latest.select(key), key, "left_anti").unionByName(latest.select(*cols))
        generation = max(time.time_ns() // 1_000_000, max(generations) + 1)
        observed = self._write(name, version, merged, checks, generation)
        try:
            self._verify(name, observed, None)
        except IntegrityError:
            self._drop_parts(version, [(p, generation) for p in parts])
            raise
        self._switch(name, version, [generation if p in set(parts) else g for p, g in enumerate(generations)])
        return Written(version, observed["rows"], parts)

    def _part(self, key: str) -> Column:
        """The bucket of a key: the hash Spark itself deals buckets out by."""
        return F.pmod(F.hash(key), F.lit(self.buckets))

    @staticmethod
    def _is_current(generations: list[int]) -> str:
        if len(set(generations)) == 1:
            return f"`{GENERATION}` = {generations[0]}L"
        listed = ", ".join(f"{g}L" for g in generations)
        return f"`{GENERATION}` = element_at(array({listed}), `{PART}` + 1)"

    def _write(self, name: str, version: str, df: DataFrame, checks: Sequence[Check], generation: int) -> dict[str, int]:
        """Append ``df`` to a version table; the counts of violations and rows."""
        cols = [f.name for f in self.tables[name].fields]
        key = BUCKET_KEYS.get(name)
        observation = Observation(f"{version}_{generation}")
        counts = [F.count_if(c.violated).alias(c.name) for c in checks] + [F.count(F.lit(1)).alias("rows")]
        if key:
            # Observed behind the shuffle, in the tasks that write.
            df = df.repartition(self.buckets, key).observe(observation, *counts)
            df = df.select(*cols, self._part(key).alias(PART), F.lit(generation).cast("long").alias(GENERATION))
            writer = df.write.format("parquet").partitionBy(PART, GENERATION).bucketBy(self.buckets, key).sortBy(key)
        else:
            writer = df.observe(observation, *counts).select(*cols).write.format("parquet")
        writer.mode("append" if generation else "errorifexists").saveAsTable(f"`{self.database}`.`{version}`")
        return observation.get

    @staticmethod
    def _verify(name: str, observed: dict[str, int], rows: int | None) -> None:
        bad = {k: v for k, v in observed.items() if v and k != "rows"}
        if bad:
            raise IntegrityError(f"{name}: " + ", ".join(f"{k}={v}" for k, v in sorted(bad.items())))
        if rows is not None and observed["rows"] != rows:
            raise IntegrityError(f"{name}: {observed['rows']} rows written of {rows} read")

    def _switch(self, name: str, version: str, generations: list[int]) -> None:
        cols = ", ".join(f"`{f.name}`" for f in self.tables[name].fields)
        text = ",".join(map(str, generations))
        pieces = [text[i : i + _PROPERTY_CHARS] for i in range(0, len(text), _PROPERTY_CHARS)]
        properties = {"version": version, **{f"generations.{i}": piece for i, piece in enumerate(pieces)}}
        listed = ", ".join(f"'{ENGINE_TAG}.{k}'='{v}'" for k, v in properties.items())
        current = f" WHERE {self._is_current(generations)}" if generations else ""
        self.spark.sql(
            f"CREATE OR REPLACE VIEW `{self.database}`.`{name}` TBLPROPERTIES ({listed}) AS "
            f"SELECT {cols} FROM `{self.database}`.`{version}`{current}"
        )

    def _state(self, name: str) -> tuple[str, list[int]]:
        """The current version of a table and the generation of each bucket."""
        props = {r.key: r.value for r in self.spark.sql(f"SHOW TBLPROPERTIES `{self.database}`.`{name}`").collect()}
        text, i = "", 0
        while (piece := props.get(f"{ENGINE_TAG}.generations.{i}")) is not None:
            text, i = text + piece, i + 1
        return props[f"{ENGINE_TAG}.version"], [int(g) for g in text.split(",") if g]

    def current_version(self, name: str) -> str:
        return self._state(name)[0]

    def _drop_parts(self, version: str, folders: Sequence[tuple[int, int]]) -> None:
        for i in range(0, len(folders), 100):
            specs = ", ".join(f"PARTITION (`{PART}`={p}, `{GENERATION}`={g})" for p, g in folders[i : i + 100])
            self.spark.sql(f"ALTER TABLE `{self.database}`.`{version}` DROP IF EXISTS {specs}")

    def vacuum(self, keep: int = 1) -> list[str]:
        """Drop all but the newest ``keep`` versions of every table (the
        current one is always kept), and the generations of its buckets that
        are no longer current. Dropping a managed version table, or a partition
        of it, deletes its files. Returns the dropped version names.

        Like any vacuum, run it when no query still reads an old version.
        """
        dropped: list[str] = []
        names = [t.name for t in self.spark.catalog.listTables(self.database)]
        for name in self.tables:
            if name not in names:
                continue
            current, generations = self._state(name)
            versions = sorted((n for n in names if n.startswith(f"{name}__v")), reverse=True)
            keep_set = set(versions[: max(keep, 1)]) | {current}
            for v in versions:
                if v not in keep_set:
                    self.spark.sql(f"DROP TABLE IF EXISTS `{self.database}`.`{v}`")
                    dropped.append(v)
            if generations:
                listed = self.spark.sql(f"SHOW PARTITIONS `{self.database}`.`{current}`").collect()
                folders = [tuple(int(x.split("=")[1]) for x in r.partition.split("/")) for r in listed]
                self._drop_parts(current, [(p, g) for p, g in folders if generations[p] != g])
        return dropped
