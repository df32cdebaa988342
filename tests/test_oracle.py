"""Every query against its SQL on the same tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from rowloom.plans import ORACLES, QUERIES
from tests.conftest import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


ORDERED = ("totals_largest_first", "listing_top20", "rollup_top20", "preview")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = duck.sql(contract.oracle_sql()[name])
    assert sorted(expected.columns) == columns
    places = [expected.columns.index(column) for column in columns]
    found_rows = [repr(tuple(row[column] for column in columns)) for row in df.collect()]
    expected_rows = [repr(tuple(row[place] for place in places)) for row in expected.fetchall()]
    if name not in ORDERED:
        found_rows, expected_rows = sorted(found_rows), sorted(expected_rows)
    assert found_rows == expected_rows


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 100
