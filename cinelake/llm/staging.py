"""Tables written once to the shared folder and removed when no longer read."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from cinelake.session import remove_path, staging_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a reader of it.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    The path is kept on the returned frame for :func:`unstage`.
    """
    path = staging_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def unstage(*frames: DataFrame) -> None:
    """Delete staged tables that no returned plan reads any more."""
    for df in frames:
        remove_path(df.sparkSession, df._staged_path)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of steps whose results are staged: its
    cleaner acts when the driver's garbage collector has found the plan unused."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_cinelake_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="cinelake-py-")) / "cinelake_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._cinelake_shipped = True
