"""Every registered query against its expected result, value by value."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from oracle.queries import ORACLE
from tributary.plans.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("orders", "lineitem", "events", "embeddings")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def warehouse():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as from '{FOLDER}/{name}.parquet'")
    yield connection
    connection.close()


def test_every_reference_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, warehouse, name):
    df = entry_points.queries()[name](spark, FOLDER)
    result = warehouse.execute(entry_points.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    expected = [dict(zip(types, row)) for row in result.fetchall()]
    assert {
        field.name: TYPES.get(field.dataType.simpleString(), field.dataType.simpleString().upper())
        for field in df.schema
    } == types
    columns = sorted(types)
    assert sorted(repr([row[c] for c in columns]) for row in df.collect()) == sorted(
        repr([row[c] for c in columns]) for row in expected
    )


def test_flagship(spark):
    assert entry_points.entry(spark).count() > 0
