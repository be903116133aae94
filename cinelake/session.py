"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Settings every session of the engine relies on. Correctness never depends
# on them (queries state NULL order, rounding and tie-breaks explicitly);
# they only shape the physical plan.
_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cinelake",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return (or create) a session with the engine's defaults.

    On a cluster, ``master`` stays ``None`` so the launcher decides; local
    runs and tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session. Where it is unset, a folder beside the session's warehouse is
    used, which every executor reaches as well.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        current = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "-checkpoints"
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, files = _file_system(spark, path)
    return files.exists(where)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staged folder, if it is there."""
    where, files = _file_system(spark, path)
    files.delete(where, True)


# Staged folders made inside open scopes, innermost last.
_SCOPES: list[list[str]] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory under the shared checkpoint folder."""
    path = os.path.join(checkpoint_dir(spark), "staged", f"{name}-{uuid.uuid4().hex}")
    for scope in _SCOPES[-1:]:
        scope.append(path)
    return path


@contextlib.contextmanager
def staged_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediates staged inside the block when it ends.

    For work that writes or prints its result inside the block: a DataFrame
    that still reads a staged copy must not be used after it.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_path(spark, path)
