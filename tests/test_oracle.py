"""Every exactly-checkable query against its DuckDB twin (small scale)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from orchard.sources.tables import TABLES
from tests.conftest import SF_SMALL

SQL = E.oracle_sql()
NAMES = sorted(SQL)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_a_callable():
    assert set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 10
    assert set(df.columns) >= {"k", "accuracy"}
