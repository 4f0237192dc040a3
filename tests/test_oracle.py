"""Every registered query with SQL against an independent engine, on the whole tables."""

from __future__ import annotations

import os

import pytest

from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = "nation customer orders lineitem events pages".split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _lines(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("" if row[i] is None else str(row[i]) for i in order) for row in rows)


def test_every_query_with_sql_is_registered():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, db, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = db.execute(ORACLE[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    rows = expected.fetchall()
    assert rows, "an empty result checks nothing"
    assert _lines(result.collect(), result.columns) == _lines(rows, names)
