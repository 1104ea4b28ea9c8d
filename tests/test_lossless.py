"""Records, keys and runs whose values were once lost or changed."""

import json

from pyspark.sql import functions as F

from millrace.functions import timefn
from millrace.functions.text import snake_key
from millrace.operators import flatten
from millrace.operators.validate import ERRORS, NOT_OBJECT
from millrace.plans.transform import TransformSpec, transform


def test_depth_has_no_limit(payloads, records):
    deep = {"Leaf Name": " x "}
    for _ in range(12):
        deep = {"Sub Items": ["mixed", deep]}
    valid, _ = transform(payloads({"id": "1", **deep}), TransformSpec(required=("id",)))
    (got,) = records(valid)
    for _ in range(12):
        got = got["sub_items"][1]
    assert got == {"leaf_name": "x"}


def test_numbers_sort_as_numbers_and_texts_as_texts(payloads, records):
    spec = TransformSpec(keys=("id",), sort="v")
    for low, high in ((9, 10), (-2, 1.5), ("10", "9"), (10**17, 10**17 + 1), (7, "text")):
        valid, _ = transform(payloads({"id": "k", "v": high}, {"id": "k", "v": low}, {"id": "k"}), spec)
        assert [r["v"] for r in records(valid)] == [high]


def test_records_that_are_no_objects_are_set_aside_whole(payloads):
    valid, rejected = transform(payloads({"id": "1"}, [1, 2], '"text"', "7"), TransformSpec(required=("id",)))
    assert valid.count() == 1
    rows = rejected.select(F.to_json("payload").alias("p"), ERRORS).collect()
    assert sorted(json.dumps(json.loads(r.p)) for r in rows) == ['"text"', "7", "[1, 2]"]
    assert all(r[ERRORS] == [NOT_OBJECT] for r in rows)


def test_typed_flatten_keeps_field_names(payloads):
    df = flatten.type_payload(payloads({"VOIDED_AT": "x", "VOID": None, "MY OBJECT<": {"OBJECT": 1}}), "payload")
    assert set(df.columns) == {"ordinal", "VOIDED_AT", "VOID", "MY OBJECT<"} and df.first()["VOIDED_AT"] == "x"


def test_final_line_breaks(spark):
    row = spark.createDataFrame([("user\n", "2024-01-15T10:30:00Z\n", "2024-01-15\n")], "k string, a string, b string")
    out = row.select(snake_key("k"), timefn.normalize_ts("a"), timefn.normalize_ts("b")).first()
    assert tuple(out) == ("user", None, None)
