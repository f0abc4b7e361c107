"""Every query with SQL equals that SQL on the smallest tables."""

import os

import duckdb
import pytest

from riskloom.queries import ORACLES, QUERIES
from riskloom.queries.tables import ALL_TABLES

DATA = os.environ.get("RISKLOOM_TEST_DATA", "/root/testdata/sf0.001")
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ALL_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(cell is None, str(cell)) for cell in row])


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    columns = sorted(frame.columns)
    relation = duck.sql(ORACLES[name])
    assert columns == sorted(relation.columns)
    declared = dict(zip(relation.columns, relation.types))
    assert {c: TYPES.get(str(declared[c])) for c in columns} == {c: dict(frame.dtypes)[c] for c in columns}
    expected = relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    actual = [tuple(row) for row in frame.select(*[f"`{c}`" for c in columns]).collect()]
    assert ordered(actual) == ordered(expected)


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry.entry(spark).columns[0] == "productcd"
