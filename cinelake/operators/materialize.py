"""Materialise an intermediate result once, as parquet in the shared folder.

Used where several plans read the same intermediate (shared aggregates of a
dashboard page) or where two passes must see identical rows (dense keys).
The files live under ``spark.checkpoint.dir``, so they survive the loss of
any executor, and each call writes a fresh directory (never overwriting
something a running plan reads).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cinelake.session import staging_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a DataFrame reading the written copy."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def materialize_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``materialize``, and how many rows passed on their way into the copy."""
    seen = Observation()
    copy = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return copy, seen.get["rows"]
