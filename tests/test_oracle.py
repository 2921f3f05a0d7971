"""Every registered query against its DuckDB equivalent, on whole tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from curbside.plans import catalog, oracle  # noqa: E402

QUERIES, ORACLE = catalog.QUERIES, {name: oracle.statement(name) for name in oracle.QUERIES}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for f in os.listdir(data):
        name = f.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{f}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def test_same_names():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equal(name, spark, data, duck):
    df = QUERIES[name](spark, data)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    want = rows_of(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert len(got) == len(want)
    assert got == want
