"""Every query against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

from harness.oracle import ORACLE
from harness.registry import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for file in os.listdir(SF_DIR):
        db.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return db


def plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    assert not isinstance(value, decimal.Decimal), "results must not hold decimals"
    return repr(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    assert got == expected and got
