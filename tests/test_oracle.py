"""Every registered query against its DuckDB oracle on the smallest tables (driver-style
compare: row count, column names, order-insensitive value hash)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from boxstats.plans.oracle import ORACLE
from boxstats.plans.queries import QUERIES
from boxstats.sources.tables import DRIVER_TABLES

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
from check_oracle import frame_hash  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "user_id" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)
