"""Dense surrogate keys 1..N in a given order (``SERIAL`` after
``RESTART IDENTITY``), without a global un-partitioned window.

Two passes over a materialised, range-partitioned copy:

1. sort by the order (range exchange; partition i holds only rows that
   precede those of partition i+1), tag every row with
   ``monotonically_increasing_id`` (partition index in the high bits, row
   position in the low 33 bits) and write the tagged rows as parquet to the
   shared checkpoint folder — both passes then read the same immutable
   rows, and a lost executor recomputes nothing upstream;
2. count rows per partition (one row per partition), turn the counts into
   start offsets, and add each row's position inside its partition, which
   ``monotonically_increasing_id`` already encodes in its low 33 bits.

The offsets table has one row per partition — bounded by the partition
count, not by the data — so broadcasting it is safe.

Keys in lake order need no sort: the copy keeps the file split of every row
and its place in the scan, and offsets are joined on the split. Both passes
read the copy, so how a later scan would cut the files does not matter, and the
number of rows that went into it is returned for the writer to compare.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinelake.operators.joins import fits_broadcast
from cinelake.operators.materialize import materialize, materialize_counted

# Most bytes of split offsets that are broadcast (some millions of splits).
OFFSETS_BUDGET = 128 << 20

_MID = "_dense_mid"
_PID = "_dense_pid"


def _assign(tagged: DataFrame, name: str, start: int) -> DataFrame:
    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    pos_in_partition = F.col(_MID) - F.shiftleft(F.col(_PID), 33)
    keyed = tagged.join(F.broadcast(offsets), _PID, "inner")
    return keyed.withColumn(name, F.col("_offset") + pos_in_partition + F.lit(start)).drop(
        _PID, _MID, "_offset"
    )


@dataclass(frozen=True)
class Numbered:
    """Rows with their keys, and how many rows were read to number them."""

    rows: DataFrame
    scanned: int


def number_in_order(df: DataFrame, order: Sequence[Column | str], name: str = "id", start: int = 1) -> Numbered:
    """Add ``name`` = start, start+1, … following ``order``.

    ``order`` should be total (end with a unique key); rows that tie on all
    of it are interchangeable only if they are identical.
    """
    ordered = df.orderBy(*order)
    tagged = ordered.withColumn(_MID, F.monotonically_increasing_id()).withColumn(
        _PID, F.shiftright(F.col(_MID), 33)
    )
    copy, scanned = materialize_counted(tagged, "dense-index")
    return Numbered(_assign(copy, name, start), scanned)


def dense_index(df: DataFrame, order: Sequence[Column | str], name: str = "id", start: int = 1) -> DataFrame:
    """The rows of ``number_in_order``."""
    return number_in_order(df, order, name, start).rows


def number_in_scan_order(
    df: DataFrame,
    split_cols: Sequence[str],
    row_col: str | None = None,
    name: str = "id",
    start: int = 1,
) -> Numbered:
    """Dense keys in lake order without sorting or shuffling the data.

    ``split_cols`` identify a file split (file, split start) and order the
    splits; ``row_col`` is ``monotonically_increasing_id`` taken at the scan, or
    None to take it here, where ``df`` may only have been filtered since the scan.
    Rows are written once, with their split and place, to the shared folder. One
    counting pass over that copy gives a row per split, whose start offset is
    joined back on the split: broadcast after measuring it. Places of a split that
    are not contiguous (rows filtered out after ``row_col`` was taken, or moved by
    a shuffle) are an error; use ``dense_index`` for such rows.
    """
    # The place is written once: under its own name, or as ``_MID`` where taken here.
    place, added = (_MID, [_MID]) if row_col is None else (row_col, [])
    if added:
        df = df.withColumn(_MID, F.monotonically_increasing_id())
    tagged, scanned = materialize_counted(df, "scan-order")
    splits = tagged.groupBy(*split_cols).agg(
        F.count(F.lit(1)).alias("_n"), F.min(place).alias("_base"), F.max(place).alias("_last")
    )
    before = Window.orderBy(*split_cols).rowsBetween(Window.unboundedPreceding, -1)
    gap = F.raise_error(F.concat(F.lit("rows of a file split are missing: "), F.col(split_cols[0]))).cast("long")
    whole = F.col("_last") - F.col("_base") + 1 == F.col("_n")
    offsets = materialize(
        splits.select(
            *split_cols,
            # What turns a row's place into its distance from the first row.
            F.when(whole, F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_base")).otherwise(gap).alias("_offset"),
        ),
        "split-offsets",
    )
    side = F.broadcast(offsets) if fits_broadcast(offsets, OFFSETS_BUDGET) else offsets
    # A left join loses no row: one without an offset would have no key.
    keyed = tagged.join(side, list(split_cols), "left")
    return Numbered(keyed.withColumn(name, F.col("_offset") + F.col(place) + F.lit(start)).drop("_offset", *added), scanned)


def dense_index_in_scan_order(
    df: DataFrame,
    split_cols: Sequence[str],
    row_col: str | None = None,
    name: str = "id",
    start: int = 1,
) -> DataFrame:
    """The rows of ``number_in_scan_order``."""
    return number_in_scan_order(df, split_cols, row_col, name, start).rows
