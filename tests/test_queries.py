"""Every registered query against its SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("FOLIANT_TESTDATA", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for name in os.listdir(FOLDER):
        con.execute(f"create view {name.split('.')[0]} as select * from read_parquet('{FOLDER}/{name}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    if name in SQL:
        cursor = db.execute(SQL[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == columns
        assert rows == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).columns
