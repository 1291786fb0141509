"""Every registered document query against its SQL, on the smallest tables."""

import math
import os

import duckdb
import pytest

from quarry.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


def shown(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    found = catalogue.QUERIES[name](spark, DATA)
    rel = duck.sql(catalogue.ORACLE_SQL[name])
    columns = sorted(found.columns)
    assert columns == sorted(rel.columns)
    place = [rel.columns.index(c) for c in columns]
    want = sorted([shown(r[k]) for k in place] for r in rel.fetchall())
    got = sorted([shown(r[c]) for c in columns] for r in found.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_query_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_flagship(spark):
    rows = catalogue.flagship(spark, DATA).collect()
    assert sum(r["candidates"] for r in rows) > 0
