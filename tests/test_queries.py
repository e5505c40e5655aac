"""Every query with SQL gives the rows of that SQL on DuckDB; the others give rows."""

import math

import duckdb
import pytest

from corvane.plans import registry
from corvane.plans.fixtures import TABLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return round(float(v), 9) if hasattr(v, "as_tuple") else v


def order(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = registry.QUERIES[name](spark, sf_dir)
    got = sorted((tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=order)
    if name not in registry.ORACLES:
        assert len(df.columns) and got
        return
    rel = duck.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in sorted(rel.columns)]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=order)


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(registry.QUERIES) <= set(e.queries())


def test_flagship(spark, sf_dir):
    df = registry.flagship(spark, sf_dir)
    assert df.columns == ["source", "tier", "decision", "segments", "hours"] and df.count() > 0
