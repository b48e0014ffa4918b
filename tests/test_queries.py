"""Every query against its SQL on the smallest tables, as the driver does it."""

import decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry


def norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    return str(list(v)) if isinstance(v, (list, tuple)) else str(v)


@pytest.fixture(scope="module")
def duck(data):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    c.sql("set timezone = 'UTC'")
    for p in Path(data).glob("*.parquet"):
        c.sql(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, data, duck, name):
    df = entry.queries()[name](spark, data)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    assert len(set(got)) == len(got)
    sql = entry.oracle_sql().get(name)
    if sql:
        r = duck.sql(sql)
        at = {c: i for i, c in enumerate(r.columns)}
        assert sorted(at) == cols
        assert got == sorted(tuple(norm(x[at[c]]) for c in cols) for x in r.fetchall())


def test_entry(spark, data):
    assert entry.entry(spark).count() > 0


def test_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
