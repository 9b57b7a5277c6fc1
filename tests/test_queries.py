"""Every registered query against its SQL in another engine, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from core_helpers import SF
from reviewtide.checks.oracle import oracles
from reviewtide.checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{file}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, repr(v)) for v in row])


def test_each_query_has_an_oracle():
    assert QUERIES.keys() == oracles().keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert oracles().keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cursor = duck.execute(oracles()[name])
    at = {c[0]: i for i, c in enumerate(cursor.description)}
    assert sorted(at) == columns
    expected = [tuple(row[at[c]] for c in columns) for row in cursor.fetchall()]
    assert expected
    assert ordered(map(tuple, df.select(columns).collect())) == ordered(expected)


def test_entry(spark):
    assert contract.entry(spark).count() == 14  # by day and night: five kept categories, '' and null
