"""Every registered query against its independent SQL statement (DuckDB) on the smallest driver
data set: same columns, same row count, same order-insensitive values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import pytest

import __spark_entry__ as E
from headway.plans.registry import registry

DATA = os.environ.get("HEADWAY_TEST_DATA", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


# Spark simple type -> DuckDB type name
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT"}


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{DATA}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "snapshot_count" in df.columns


def test_every_query_has_oracle():
    assert set(registry()) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    if not os.path.isdir(DATA):
        pytest.skip("driver data not present")
    df = E.queries()[name](spark, DATA)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    rel = duck.sql(E.oracle_sql()[name])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: DUCK_TYPES.get(t, t) for c, t in df.dtypes} == otypes
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, cols) == _canon(orows, ocols)
