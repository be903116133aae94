"""The CSV data lake: headered text files where every field is a string.

Reading never infers types. Header names are stripped, the reader's
missing-value tokens become NULL, and each row can carry its position in the
lake (file, split, row) so that "last row wins" and "keys in file order"
have a meaning that survives splitting a file across tasks.
"""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinelake.functions.scalar import na_to_null
from cinelake.schemas import all_string

# Position columns added by ``read_lake_csv(with_position=True)``.
POS_FILE = "_pos_file"
POS_SPLIT = "_pos_split"
POS_ROW = "_pos_row"
POSITION_COLUMNS = (POS_FILE, POS_SPLIT, POS_ROW)


def _csv_reader(spark: SparkSession, multiline: bool):
    # Quotes inside quoted fields are doubled by the lake writer, so the
    # escape character is the quote itself; FAILFAST rejects ragged rows.
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("multiLine", multiline)
    )


def lake_header(spark: SparkSession, path: str | list[str], multiline: bool = False) -> list[str]:
    """Column names as written in the header (unstripped)."""
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path).columns


def files_by_line_breaks(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files under ``path`` without and with quoted line breaks.

    A record on one line has an even number of quotes, as they are doubled inside
    fields; a line with an odd number opens or closes a field of several lines.
    (A stray quote in an unquoted field counts as well: such a file is read as
    one piece, which is right, only slower.) One pass over the lines; only file
    names reach the driver, which lists them anyway.
    """
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # Few lines hold quotes: only these are counted, and only odd ones name their file.
    odd = lines.where(F.col("value").contains('"') & (quotes % 2 == 1)).select(F.col("_metadata.file_path").alias("file"))
    # Spark reports file names URL-encoded and reads them plain.
    broken = {unquote(r.file) for r in odd.distinct().collect()}
    if not broken:
        return sorted(unquote(f) for f in lines.inputFiles()), []
    files = sorted(unquote(r.file) for r in lines.select(F.col("_metadata.file_path").alias("file")).distinct().collect())
    return [f for f in files if f not in broken], [f for f in files if f in broken]


def _read(
    spark: SparkSession, path: str | list[str], columns: list[str] | None, with_position: bool, multiline: bool
) -> DataFrame:
    header = lake_header(spark, path, multiline)
    df = _csv_reader(spark, multiline).schema(all_string(header)).csv(path)
    stripped = [c.strip() for c in header]
    df = df.toDF(*stripped)
    wanted = columns or stripped
    missing = [c for c in wanted if c not in stripped]
    if missing:
        raise ValueError(f"{path}: missing lake columns {missing}")
    position = []
    if with_position:
        position = [
            F.col("_metadata.file_path").alias(POS_FILE),
            F.col("_metadata.file_block_start").alias(POS_SPLIT),
            F.monotonically_increasing_id().alias(POS_ROW),
        ]
    return df.select(*[na_to_null(c).alias(c) for c in wanted], *position)


def read_lake_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    with_position: bool = False,
    multiline: bool | None = False,
) -> DataFrame:
    """Scan lake CSV file(s) as all-string columns.

    Names come from the file's header and are stripped (``' title '`` →
    ``'title'``); with ``columns`` those are selected in that order and a
    missing one is an error. Missing-value tokens become NULL. With
    ``with_position`` the scan also records where each row came from; the
    row number is taken right at the scan, before any shuffle, and is stable
    on task retry because file splits are deterministic.

    ``multiline``: fields may hold quoted line breaks. False: a line break
    fails the scan. True: every file is read as one piece by one task (its only
    split starts at 0). None: found out per file, so that only files that hold
    line breaks lose their splits.
    """
    if multiline is not None:
        return _read(spark, path, columns, with_position, multiline)
    plain, broken = files_by_line_breaks(spark, path)
    if not broken:
        return _read(spark, path, columns, with_position, False)
    parts = [_read(spark, files, columns, with_position, many) for files, many in ((plain, False), (broken, True)) if files]
    return reduce(DataFrame.unionByName, parts)


def write_lake_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a lake table as headered CSV (no index column), quoting with
    doubled quotes so comma-separated genre lists round-trip, and keeping
    white space around values (values with line breaks are quoted; read them
    back with ``multiline``)."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("quoteAll", False)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
