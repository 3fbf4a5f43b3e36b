"""Every named query against its SQL, over the whole tables."""

from __future__ import annotations

import datetime as dt

import duckdb
import pytest

from trialweave.catalog.oracle import ORACLE_SQL
from trialweave.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(plain, key=repr)


_KINDS = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE_SQL[name])
    columns = [column[0] for column in expected.description]
    kinds = {column[0]: str(column[1]) for column in expected.description}
    want = _rows(columns, expected.fetchall())
    got = _rows(df.columns, [tuple(row) for row in df.collect()])
    assert got == want
    assert want[1], "a query without rows proves nothing"
    assert {column: _KINDS[kind] for column, kind in df.dtypes} == kinds
