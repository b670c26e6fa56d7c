"""Every query of ``workload`` against its SQL, on whole tables at the smallest scale."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value)


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(record[i]) for i in order) for record in records)


@pytest.mark.parametrize("name", sorted(name for registry in entry.REGISTRIES for name in registry.queries))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, FOLDER)
    records = [tuple(r) for r in got.collect()]
    assert len(set(got.columns)) == len(got.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert records
        return
    result = db.execute(sql)
    expected_names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(expected_names)
    assert rows(got.columns, records) == rows(expected_names, result.fetchall())


def test_entry_has_a_stable_schema(spark):
    assert entry.entry(spark).columns == [
        "entity", "name", "period", "a", "a_low", "a_high", "b", "b2", "grp", "grp_code",
        "a_change", "b_change", "a_rank", "b_rank",
    ]
