"""Every registered query against DuckDB over the smallest tables."""

import math
import os

import duckdb
import pytest

from skein.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else None if v is None else str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(str([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", catalogue.QUERIES)
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    if name in catalogue.ORACLES:
        want = duck.sql(catalogue.ORACLES[name])
        assert got == table(want.columns, want.fetchall())
    else:
        assert len(set(df.columns)) == len(df.columns)
