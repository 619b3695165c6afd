"""Every registered query gives the rows of its SQL in DuckDB over the same tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, sf, duck, name):
    result = queries()[name](spark, sf)
    found = canonical(result.columns, result.collect())
    duck.execute(oracle_sql()[name])
    expected = canonical([column[0] for column in duck.description], duck.fetchall())
    assert found[0] == expected[0]
    assert len(found[1]) == len(expected[1])
    assert found[1] == expected[1]
    assert found[1]


def test_entry_runs(spark):
    assert len(entry(spark).collect()) == 10
