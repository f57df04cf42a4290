"""Every registered query against its SQL twin on the small tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
from conftest import SAMPLE_DIR
from eventlake.plans import oracle
from eventlake.plans import queries as registry

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}
QUERIES = registry.all_queries()
SQL = oracle.all_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SAMPLE_DIR}/{name}.parquet'")
    return connection


def _normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SAMPLE_DIR)
    found = duck.execute(SQL[name])
    types = {d[0]: str(d[1]) for d in found.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    columns = [d[0] for d in found.description]
    expected = found.fetchall()
    assert expected
    assert _normal([tuple(r) for r in df.collect()], df.columns) == _normal(expected, columns)


def test_every_sql_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
