"""Every registered query against its DuckDB oracle on the smallest tables,
plus the entry smoke check."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as se
from lakeward.plans.catalog import QUERIES
from lakeward.plans.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = se.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, orows)


def test_entry(spark):
    out = se.entry(spark)
    assert out.columns == ["check_name", "passed", "message"] and out.count() == 6


def test_every_query_is_documented():
    assert all(fn.__doc__ and fn.__doc__.strip() for fn in QUERIES.values())
