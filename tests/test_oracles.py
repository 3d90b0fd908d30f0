"""Every registered query against its SQL equivalent, on whole tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def test_every_query_has_an_oracle():
    assert {query.__name__ for query in entry_module.QUERIES} <= set(ORACLES)


@pytest.mark.parametrize("name", sorted(query.__name__ for query in entry_module.QUERIES))
def test_query_matches_oracle(spark, db, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = db.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(frame.columns) == sorted(columns)
    actual = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    expected = _rows(columns, result.fetchall())
    assert len(actual) == len(expected)
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not wrong, wrong[:3]
