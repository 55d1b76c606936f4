"""Every core query with SQL against DuckDB on the smallest tables."""

import decimal
import glob
import math
import os

import duckdb
import pytest

from curatrix.plans import registry

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")


def plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5)
    return v


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, duck, name):
    df = registry.queries()[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted([tuple(plain(r[c]) for c in columns) for r in df.collect()], key=repr)
    result = duck.sql(registry.oracle_sql()[name])
    assert sorted(result.columns) == columns
    at = [result.columns.index(c) for c in columns]
    assert got == sorted([tuple(plain(r[i]) for i in at) for r in result.fetchall()], key=repr)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, DIR).columns
