"""Every registered query equals its DuckDB oracle on the small test data."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cinelake.registry import REGISTRY
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(entry.queries())
    assert set(REGISTRY) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["primary_genre", "movie_id", "title", "avg_score", "total_ratings"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)


_DUCK_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
               "DATE": "date", "BOOLEAN": "boolean"}


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_types_match_oracle(spark, duck, key):
    spark_types = {f.name: f.dataType.simpleString() for f in entry.queries()[key](spark, SF_SMALL).schema.fields}
    res = duck.execute(f"SELECT * FROM ({entry.oracle_sql()[key]}) LIMIT 0")
    duck_types = {d[0]: _DUCK_TYPES.get(str(d[1]), str(d[1])) for d in res.description}
    assert spark_types == duck_types
