"""Every query of the core against its SQL, over whole tables; those without SQL against their schema."""

import glob
import os

import duckdb
import pytest

from tracewright.plans import registry


def _norm(v):
    return round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, (list, dict)) else v


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for f in glob.glob(f"{data}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, data, con, name):
    df = registry.queries()[name](spark, data)
    cols = sorted(df.columns)
    own = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=str)
    other = con.sql(registry.oracle_sql()[name])
    assert sorted(other.columns) == cols
    at = [other.columns.index(c) for c in cols]
    assert own == sorted((tuple(_norm(r[i]) for i in at) for r in other.fetchall()), key=str)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, data, name):
    assert registry.queries()[name](spark, data).count() >= 0


def test_every_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
