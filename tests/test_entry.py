"""Driver contract: entry, queries and their DuckDB oracle at sf0.001."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from caldim.plans import catalog
from conftest import SF0001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return "NaN" if isinstance(v, float) and math.isnan(v) else repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and "ytd_sales" in df.columns


def test_every_query_has_an_oracle():
    """Of this package's own operators; those of optional parts have tests of their own."""
    assert set(catalog.QUERIES) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF0001)
    srows, scols = [r.asDict() for r in sdf.collect()], sdf.columns
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = [dict(zip(ocols, r)) for r in res.fetchall()]
    assert sorted(scols) == sorted(ocols)
    key = sorted(scols)
    assert sorted("|".join(_norm(r[c]) for c in key) for r in srows) == \
        sorted("|".join(_norm(r[c]) for c in key) for r in orows)
