"""Every query of the catalog against its SQL."""

import os

import duckdb
import pytest

import __spark_entry__
from leafmill.plans import catalog, layouts  # noqa: F401  layouts adds to the catalog


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in os.listdir(sf):
        c.execute(f"create view {f[:-8]} as select * from read_parquet('{sf}/{f}')")
    return c


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_sql(spark, sf, con, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    out = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in out.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in out.fetchall())
    assert sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect()) == want


def test_contract():
    assert set(catalog.ORACLES) <= set(__spark_entry__.queries()) and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
