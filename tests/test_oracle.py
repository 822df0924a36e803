"""Every named query against its DuckDB form on the sf0.001 tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from cardwatch.plans.queries import registry
from conftest import SF0001
from helpers import digest

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


#: the warehouse's own queries; the optional training-data queries have their tests in their own folder
CORE = sorted(registry())


def test_every_core_query_has_an_oracle():
    assert len(CORE) >= 49
    assert set(CORE) <= set(E.queries())
    assert set(CORE) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF0001)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df) == digest(cur.fetchall(), ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0
