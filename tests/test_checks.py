"""Every registered query against DuckDB on the same files."""

import os
import time

import duckdb
import pytest

import __spark_entry__ as entry
from checks.files import TABLES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    start = time.time()
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    print(f"{name} {time.time() - start:.1f}s {len(got)} rows")
    relation = duck.sql(entry.oracle_sql()[name])
    want = rows_of(relation.columns, relation.fetchall())
    assert sorted(df.columns) == sorted(relation.columns)
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    # Type names that mean the same on both sides.
    same = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}
    assert {n: same[t] for n, t in df.dtypes} == kinds
    assert len(got) == len(want) and len(got) > 0
    assert got == want


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
