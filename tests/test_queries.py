"""Every structural query with SQL gives DuckDB's rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from foldlake.plans import catalogue


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in os.listdir(data):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{data}/{name}'")
    return con


def plain(rows, names):
    """The rows as sorted texts, with columns by name."""
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, duck, data, name):
    got = catalogue.QUERIES[name](spark, data)
    want = duck.execute(catalogue.ORACLE_SQL[name])
    names = [x[0] for x in want.description]
    assert sorted(got.columns) == sorted(names)
    assert plain(got.collect(), got.columns) == plain(want.fetchall(), names)


def test_entry_and_registry(spark, data):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for name in set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL):
        assert catalogue.QUERIES[name](spark, data).count() > 0
