import math

import duckdb
import pytest

import __spark_entry__ as entry
from leafwright.plans import catalog


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="session")
def duck(sf):
    import os

    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"create view {t.split('.')[0]} as select * from '{sf}/{t}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_against_sql(spark, sf, duck, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    rows = sorted(str([norm(r[c]) for c in cols]) for r in df.collect())
    if name not in catalog.SQL:
        return
    cur = duck.execute(catalog.SQL[name])
    have = [d[0] for d in cur.description]
    assert sorted(have) == cols
    want = sorted(str([norm(r[have.index(c)]) for c in cols]) for r in cur.fetchall())
    assert rows == want


def test_entry(spark, sf):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())
