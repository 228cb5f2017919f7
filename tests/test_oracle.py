"""Every query with SQL gives the rows that another engine gives; the others run."""

import datetime
import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from pagemill.queries import FIXED, FIXED_SQL

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries() | FIXED, entry.oracle_sql() | FIXED_SQL


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, bool) or v is None or isinstance(v, (str, bytes)):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return "nan" if math.isnan(v) else repr(round(float(v), 6) + 0.0)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    rel = duck.execute(SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in rel.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQL and not n.startswith("op") and n != "pipeline"))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).collect() is not None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
