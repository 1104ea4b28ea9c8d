from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("work")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def payloads(spark):
    """(ordinal, payload) rows of records given as dicts or JSON texts."""

    def make(*records):
        texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
        rows = spark.createDataFrame(list(enumerate(texts)), "ordinal bigint, text string")
        return rows.select("ordinal", F.parse_json("text").alias("payload"))

    return make


@pytest.fixture
def records():
    """Payloads of a DataFrame as dicts, in input order."""

    def read(df, column="payload"):
        rows = df.select("ordinal", F.to_json(column).alias("r")).orderBy("ordinal").collect()
        return [json.loads(r.r) for r in rows]

    return read
