"""Every registered query runs; those with SQL equal DuckDB's answer on the same files."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    verdict = compare(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert not verdict.startswith("FAIL"), verdict


def test_entry(spark):
    assert entry(spark).count() > 0
