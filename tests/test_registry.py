"""Every registered query against its SQL on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

from brightledger.plans import registry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, Decimal)):
        return None if math.isnan(float(v)) else round(float(v), 6)
    return str(v)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    df = registry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in df.collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())


def test_descriptions():
    assert len(registry.described("growth")) >= 3
    assert all(text for _, text in registry.described())
