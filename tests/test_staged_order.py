"""Staged files of orders keep the order of the orders, whatever order the table has."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from harness import registry
from harness.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def turned(spark, tmp_path_factory):
    """The orders from the last to the first."""
    root = tmp_path_factory.mktemp("turned")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").orderBy(F.desc("o_orderkey")).coalesce(1)
    orders.write.parquet(str(root / "orders.parquet"))
    return str(root)


def test_lines_of_a_file_are_in_their_order(spark, turned):
    files = spark.read.option("recursiveFileLookup", "true").text(registry._order_lines(spark, turned), wholetext=True)
    keys = [[int(k) for k in re.findall(r'^\{"id": ?"?(\d+)', text, re.MULTILINE)] for (text,) in files.collect()]
    assert all(k == sorted(k) for k in keys) and max(map(len, keys)) > 1


@pytest.mark.parametrize("name", ["failed_loads", "load_history", "staged_history"])
def test_first_errors_match_sql(spark, turned, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW orders AS SELECT * FROM '{turned}/orders.parquet/*.parquet'")
    cursor = db.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    got = registry.QUERIES[name](spark, turned).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, cursor.fetchall()))
