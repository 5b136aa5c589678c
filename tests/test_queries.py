"""Registered queries against their SQL counterparts at the smallest scale."""

import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(sf):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def _sorted(rows, names, columns):
    order = [names.index(c) for c in columns]
    return sorted(repr([row[at] for at in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, sf, oracle, name):
    got = entry.queries()[name](spark, sf)
    rows = [tuple(r) for r in got.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = oracle.execute(sql)
    names = [d[0] for d in cursor.description]
    columns = sorted(got.columns)
    assert sorted(names) == columns
    assert _sorted(rows, got.columns, columns) == _sorted(cursor.fetchall(), names, columns)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
