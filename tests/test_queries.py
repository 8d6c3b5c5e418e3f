"""Every registered query against its SQL over the smallest tables."""

import glob
import os

import duckdb
import pytest

from parallax.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def tables(data):
    connection = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows(table, columns):
    return sorted(repr(tuple(r[c] for c in columns)) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, data, tables, name):
    got = QUERIES[name](spark, data).toArrow()
    want = tables.sql(SQL[name]).to_arrow_table()
    columns = sorted(got.column_names)
    assert columns == sorted(want.column_names)
    assert rows(got, columns) == rows(want, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, data, name):
    assert QUERIES[name](spark, data).columns
    QUERIES[name](spark, data).count()


def test_entry(spark, data):
    assert registry.flagship(spark, data).count() > 0
