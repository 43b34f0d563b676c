"""Every registered payment query against its SQL in DuckDB on the smallest tables."""

import datetime
import decimal
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from payx import catalog  # noqa: E402

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


def value(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return repr(round(v, 5) + 0.0)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v else "0"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    rel = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    got = sorted("|".join(value(r[c]) for c in columns) for r in df.collect())
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted("|".join(value(r[i]) for i in at) for r in rel.fetchall())


def test_spoiled_settlements_take_every_payment(spark, sf_dir):
    plan = QUERIES["dq5_spoiled_settlements"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "l_shipdate" in line]
