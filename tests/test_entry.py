"""Every registered query with an SQL twin equals it on the smallest tables."""

import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    res = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted(repr([plain(r[i]) for i in at]) for r in res.fetchall())
    got = sorted(repr([plain(v) for v in r]) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    assert got == want


def test_flagship(spark):
    assert entry.entry(spark).count() == 4
    assert set(entry.oracle_sql()) <= set(entry.queries())
