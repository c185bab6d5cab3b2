"""Every registered query against its SQL in DuckDB."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

SF_DIR = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = [tuple(r) for r in frame.collect()]
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    assert sorted(frame.columns) == sorted(columns)
    assert by_name(frame.columns, got) == by_name(columns, expected)
    assert got


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    assert not QUERIES[name](spark, SF_DIR).isEmpty()


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
