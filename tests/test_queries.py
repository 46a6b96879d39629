"""Every query that has SQL gives the rows that DuckDB gives, on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

from kilnspark import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or isinstance(v, int):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return round(v, 6) if abs(v) < 1e6 else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    return str(v)


def rows(columns, values):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(v[i]) for i in order) for v in values), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{DATA}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    found = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, found.fetchall())


def test_queries_without_sql_run(spark):
    for name in sorted(catalog.QUERIES.keys() - catalog.ORACLES.keys()):
        assert catalog.QUERIES[name](spark, DATA).columns
