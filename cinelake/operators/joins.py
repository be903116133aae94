"""Size-checked broadcast.

A side is broadcast only after its size is measured against the session's
broadcast budget (``spark.sql.autoBroadcastJoinThreshold``): rows and
payload bytes are counted over at most ``budget / 16 + 1`` rows, so the
check itself stays small even on a huge table, and a side that does not
provably fit takes the caller's other (shuffle-based) path.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bytes a row costs in a broadcast hash relation beyond its payload
# (row header, pointer, hash slot): a deliberate over-estimate.
_ROW_OVERHEAD = 16

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
    T.DecimalType: 16,
}

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30}


def broadcast_budget(spark) -> int:
    """The session's broadcast threshold in bytes (≤ 0 means disabled)."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    m = re.fullmatch(r"(-?\d+)\s*([a-z]*)", raw)
    if not m:
        return 0
    return int(m.group(1)) * _UNITS.get(m.group(2), 1)


def _payload_bytes(df: DataFrame) -> F.Column:
    fixed = 0
    variable = []
    for f in df.schema.fields:
        width = next((w for t, w in _FIXED_WIDTH.items() if isinstance(f.dataType, t)), None)
        if width is not None:
            fixed += width
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            variable.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:  # nested values: measure their JSON text as an upper-bound proxy
            variable.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
    total = F.lit(fixed + _ROW_OVERHEAD)
    for v in variable:
        total = total + v
    return total


def fits_broadcast(df: DataFrame, budget: int | None = None) -> bool:
    """Whether ``df`` provably fits in the broadcast budget: one small job per
    call, never remembered, since files behind a plan may have changed."""
    budget = broadcast_budget(df.sparkSession) if budget is None else budget
    if budget <= 0:
        return False
    max_rows = budget // _ROW_OVERHEAD
    probe = df.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_payload_bytes(df)).alias("bytes")
    ).first()
    return probe.n <= max_rows and (probe.bytes or 0) <= budget
