"""Ingestion reads its records no more often than it has to, and its results stay those of the general expressions."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.normalize import normalize_variant
from millrace.operators.once import computed_once
from millrace.operators.shape import normalize_known, shape_of
from millrace.plans import runs
from millrace.session import whole_payloads

MIXED = (
    {"a": {"tagList": [" raw ", {"subKey": " x ", "createdAt": "2024-01-15T10:30:00Z"}, 5, None, [{"inK": " y "}]]}, "n": 1},
    {"a": {"tagList": []}, "n": " t "},
    {"a": {"tagList": [{"sub-key": 1, "subKey": " z "}, {"subKey": {"deepKey": " d "}}, {"": 1, "--": 2}]}},
    {"a": {"tagList": None}},
    {"a": None},
    {},
)


def test_objects_in_mixed_lists_are_normalised_by_their_fields(payloads, records):
    df = payloads(*MIXED)
    shape = shape_of(df, "payload")
    assert list(shape.objects) == [("a", "tagList")]
    known = records(df.withColumn("payload", normalize_known("payload", shape, ("created_at",))))
    general = records(df.withColumn("payload", normalize_variant("payload", ("created_at",))))
    assert known == general
    assert known[0]["a"]["tag_list"][:2] == [" raw ", {"created_at": "2024-01-15T10:30:00.000000Z", "sub_key": "x"}]


def test_a_known_schema_saves_the_pass(payloads):
    df = payloads({"id": 1, "b": {"c": "x"}})
    schema = df.agg(F.schema_of_variant_agg("payload")).first()[0]
    unread = df.withColumn("payload", F.raise_error(F.lit("read again")).cast("variant"))
    assert shape_of(unread, "payload", schema=schema) == shape_of(df, "payload")


def test_costly_values_are_compiled(payloads):
    df = computed_once(payloads({"id": 1}), "payload", F.parse_json(F.to_json("payload")))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    generate = next(line for line in plan.splitlines() if "Generate" in line)
    assert "to_json" not in generate.lower() and "StructsToJson" not in generate and "parse" not in generate.lower()


def test_work_folders_hold_payloads_whole(spark, payloads, tmp_path):
    key = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), whole_payloads(spark):
        assert spark.conf.get(key) == "false"
        raise RuntimeError
    assert spark.conf.get(key) == before
    report = runs.ingest_source(payloads({"id": 1, "tags": ["x", {"k": 2}]}, {"id": None}), "api_a", runs.Layout(str(tmp_path)), "b1", "2024-01-31 04:00:00")
    assert (report["records_fetched"], report["record_count"], report["records_rejected"]) == (2, 1, 1)
