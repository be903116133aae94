"""Key and reference checks that the warehouse declares but Spark does not
enforce (primary keys, foreign keys with cascade, NOT NULL, lengths,
numeric precision).

All checks are set-based. Semi/anti joins broadcast the key side only
after measuring that it fits the broadcast budget; otherwise both sides are
shuffled on the key and AQE's skew-join handling splits a key that holds a
large share of the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinelake.operators.joins import fits_broadcast
from cinelake.schemas import MAX_LENGTH


class IntegrityError(ValueError):
    """A load violated a declared key or reference."""


@dataclass(frozen=True)
class Check:
    name: str
    violated: Column


def _key_side(dim: DataFrame, key: str, dim_key: str | None, *more: Column) -> DataFrame:
    """The dimension's keys, broadcast only when they provably fit."""
    keys = dim.select(F.col(dim_key or key).alias(key), *more)
    return F.broadcast(keys) if fits_broadcast(keys) else keys


def keep_known(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose ``key`` exists in ``dim`` (membership filter)."""
    return fact.join(_key_side(dim, key, dim_key), key, "left_semi")


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows of ``fact`` whose ``key`` does not exist in ``dim``."""
    return fact.join(_key_side(dim, key, dim_key), key, "left_anti")


def enforce_references(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    policy: str = "fail",
    dim_key: str | None = None,
) -> DataFrame:
    """Apply a foreign-key policy: ``"drop"`` keeps known keys only,
    ``"fail"`` raises with the number of orphan rows (one counting job)."""
    if policy == "drop":
        return keep_known(fact, dim, key, dim_key)
    if policy != "fail":
        raise ValueError(f"unknown policy {policy!r}")
    n = orphans(fact, dim, key, dim_key).count()
    if n:
        raise IntegrityError(f"{n} rows reference an unknown {key}")
    return fact


def with_reference(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None
) -> tuple[DataFrame, Check]:
    """``fact`` with a marker of whether ``key`` exists in ``dim`` (whose keys
    are unique), and the check that counts where it does not: for a writer
    that counts violations in its own pass."""
    marker = f"_known_{key}"
    keys = _key_side(dim, key, dim_key, F.lit(True).alias(marker))
    return fact.join(keys, key, "left"), Check(f"unknown_{key}", F.col(marker).isNull())


def cascade_delete(fact: DataFrame, deleted: dict[str, DataFrame]) -> DataFrame:
    """Remove facts that reference deleted dimension rows (``ON DELETE
    CASCADE``); ``deleted`` maps a fact key column to a frame of deleted keys
    in that column."""
    out = fact
    for key, gone in deleted.items():
        out = out.join(_key_side(gone, key, None), key, "left_anti")
    return out


def duplicate_keys(df: DataFrame, key: str | Sequence[str], copies: str = "copies") -> DataFrame:
    """Key values that occur more than once, with their number of copies."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(copies)).where(F.col(copies) > 1)


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    """Raise when the key is not unique (one aggregation job)."""
    if not duplicate_keys(df, key).isEmpty():
        raise IntegrityError(f"duplicate values of {key}")


def declared_checks(schema: T.StructType) -> list[Check]:
    """NOT NULL and length checks derived from a table schema (a decimal column's
    type already rules out values beyond its precision)."""
    checks: list[Check] = []
    for f in schema.fields:
        if not f.nullable:
            checks.append(Check(f"{f.name}_not_null", F.col(f.name).isNull()))
        if f.name in MAX_LENGTH and isinstance(f.dataType, T.StringType):
            checks.append(Check(f"{f.name}_length", F.length(f.name) > MAX_LENGTH[f.name]))
    return checks


def violation_counts(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One pass over ``df``: ``(table_name, check_name, violations)`` rows.

    All checks are ``count_if`` aggregates of a single scan (partial
    aggregation per task); ``stack`` turns the one-row result into rows.
    """
    agg = df.agg(*[F.count_if(c.violated).alias(c.name) for c in checks])
    pairs = ", ".join(f"'{c.name}', `{c.name}`" for c in checks)
    return agg.selectExpr(
        f"'{table}' AS table_name", f"stack({len(checks)}, {pairs}) AS (check_name, violations)"
    )


def violation_report(tables: dict[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """Violation counts for several tables (each scanned once)."""
    out = None
    for name, (df, schema) in tables.items():
        part = violation_counts(df, name, declared_checks(schema))
        out = part if out is None else out.unionByName(part)
    return out


def enforce_declared(df: DataFrame, table: str, schema: T.StructType) -> None:
    """Strict mode: raise if any declared check is violated."""
    counts = violation_counts(df, table, declared_checks(schema)).where(F.col("violations") > 0)
    bad = counts.collect()  # at most one row per declared check
    if bad:
        detail = ", ".join(f"{r.check_name}={r.violations}" for r in bad)
        raise IntegrityError(f"{table}: {detail}")
