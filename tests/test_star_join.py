"""The star join: rows of left joins, null and repeated keys included, and how often the lines move."""

import datetime as dt
import re
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

NAME = "sales_star_join"
DAY = dt.datetime(1999, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Keys that nothing answers to, null keys on both sides, and keys that come twice in every table."""
    at = tmp_path_factory.mktemp("star")
    missing = lambda i, n, key: None if i % n == 0 else key
    made = {
        "nation": ("n_nationkey int, n_name string", [*((i, f"nation {i}") for i in range(6)), (2, "second name"), (None, "no key")]),
        "customer": ("c_custkey bigint, c_nationkey int", [*((missing(i, 50, i), missing(i, 7, i % 8)) for i in range(400)), (5, 3)]),
        "orders": ("o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz", [*((missing(i, 90, i), missing(i, 11, i % 500), DAY + dt.timedelta(i)) for i in range(2000)), (8, 5, DAY), (9, None, None)]),
        "part": ("p_partkey bigint, p_brand string", [*((missing(i, 60, i), missing(i, 9, f"brand {i % 5}")) for i in range(500)), (4, "second brand")]),
        "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_extendedprice double", [(missing(i, 70, i // 4), i % 4, missing(i, 13, i % 600), missing(i, 17, float(i))) for i in range(8800)]),
    }
    for table, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{table}.parquet")
    return str(at)


def test_star_join_equals_its_sql_on_odd_keys(spark, tables):
    con = duckdb.connect()
    for t in ("nation", "customer", "orders", "part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet/*.parquet'")
    want = con.execute(oracle_sql()[NAME]).fetchall()
    got = [tuple(r) for r in queries()[NAME](spark, tables).collect()]
    assert Counter(got) == Counter(want)
    assert len(got) > 8800  # keys that come twice


def test_star_join_moves_the_lines_once_per_large_table(spark, tables):
    changed = {"spark.sql.autoBroadcastJoinThreshold": "1k", "spark.sql.adaptive.enabled": "false"}  # nations are broadcast, all else is large
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        plan = spark._jvm.PythonSQLUtils.explainString(queries()[NAME](spark, tables)._jdf.queryExecution(), "formatted")
    finally:
        for k in changed:
            spark.conf.unset(k)
    moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]\nArguments: hashpartitioning\((\w+)#", plan)
    assert sorted(key for columns, key in moved if "l_linenumber#" in columns) == ["l_orderkey", "l_partkey"]
    assert not any("n_name#" in columns for columns, _ in moved)
