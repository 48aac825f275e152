"""Every registered query against its oracle on the smallest tables."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry_point

TINY = "/root/testdata/sf0.001"
TABLES = "nation customer supplier orders events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TINY}/{name}.parquet'")
    return connection


def canonical(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return f"{value:.6f}"
        if isinstance(value, dt.datetime):
            return value.isoformat()
        return str(value)

    return [columns[i] for i in order], sorted([cell(r[i]) for i in order] for r in records)


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query_matches_oracle(spark, oracle, name):
    df = entry_point.queries()[name](spark, TINY)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = oracle.execute(entry_point.oracle_sql()[name])
    expected = canonical([c[0] for c in result.description], result.fetchall())
    assert got == expected


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 30


def test_every_query_is_callable_and_every_oracle_has_a_query():
    queries = entry_point.queries()
    assert all(callable(query) for query in queries.values())
    assert set(entry_point.oracle_sql()) <= set(queries)
