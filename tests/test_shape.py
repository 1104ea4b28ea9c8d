"""Records of a known shape come out as the general expressions have them."""

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.flatten import flatten_records
from millrace.operators.normalize import normalize_variant
from millrace.operators.shape import MOST_FIELDS, normalize_known, shape_of
from millrace.plans import transform

STAMPS = ["created_at", "updated_at"]
KEYS = ["id", "createdAt", "updated_at", "User Name", "user-name", "a", "A", "!!", "x.y", "Zé", "tags", "__k__"]


def value(draw, depth):
    kind = draw.randrange(11 if depth else 8)
    if kind < 8:
        return [None, True, 7, 2.5, "  padded ", "2024-01-05 10:00:00", 1700000000, ""][kind]
    if kind == 8:
        return [value(draw, depth - 1) for _ in range(draw.randrange(4))]
    return record(draw, depth - 1)


def record(draw, depth):
    return {k: value(draw, depth) for k in draw.sample(KEYS, draw.randrange(6))}


def stable(draw, depth):
    """Records whose fields keep their type but may be missing or null."""
    item = {"Sku": " s ", "qty": draw.randrange(5), "updated_at": "2024-01-0%d" % draw.randrange(1, 9)}
    whole = {
        "id": " 7 ", "createdAt": "2024-01-05T10:00:00+05:00", "updatedAt": 1700000000 + draw.randrange(99), "User Name": "\tx", "user_name": "y",
        "meta": {"In-ner": {"deepKey": " z "}, "n": 1.5, "none": None}, "items": [item] * draw.randrange(3), "plain": [" a ", "b"], "empty": {},
    }
    return {k: None if draw.random() < 0.1 else v for k, v in whole.items() if draw.random() < 0.8}


def as_texts(df, column="payload"):
    return [r[0] for r in df.select("ordinal", F.to_json(column).alias("r")).orderBy("ordinal").select("r").collect()]


@pytest.mark.parametrize("make", [record, stable])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_known_equals_general(payloads, make, seed):
    draw = random.Random(seed)
    rows = payloads(*[make(draw, 3) for _ in range(60)], "null", "{}").cache()
    shape = shape_of(rows, "payload")
    assert shape is not None
    for options in ({}, {"split_acronyms": True}, {"normalize_keys": False}, {"to_utc": True}):
        known = rows.withColumn("payload", normalize_known("payload", shape, STAMPS, **options))
        general = rows.withColumn("payload", normalize_variant("payload", STAMPS, max_depth=8, **options))
        assert as_texts(known) == as_texts(general), options
    rows.unpersist()


@pytest.mark.parametrize("depth", [0, 1, 10])
def test_known_flattens_alike(payloads, depth):
    draw = random.Random(depth)
    rows = payloads(*[stable(draw, 3) for _ in range(80)], {"id": 7, "createdAt": [1], "plain": "x"})
    known = rows.withColumn("payload", normalize_known("payload", shape_of(rows, "payload", True), STAMPS, flatten_depth=depth))
    flat = flatten_records(rows, max_depth=depth)
    general = flat.withColumn("payload", normalize_variant("payload", STAMPS, max_depth=8))
    assert as_texts(known) == as_texts(general)


def test_objects_among_other_values_are_flattened_in_general(payloads):
    rows = payloads({"a": {"b": " x "}}, {"a": 3}, {"a": [{"Q": " y "}]})
    assert shape_of(rows, "payload", True).mixed_objects
    with pytest.raises(ValueError):
        normalize_known("payload", shape_of(rows, "payload"), flatten_depth=3)
    valid, _ = transform.transform(rows, transform.TransformSpec(flatten=True))
    assert as_texts(valid) == ['{"a_b":"x"}', '{"a":3}', '{"a":[{"q":"y"}]}']


def test_no_shape_for_other_records(payloads):
    assert shape_of(payloads({"a": 1}, "[1]"), "payload") is None
    assert shape_of(payloads({'a"b': 1}), "payload") is None
    assert shape_of(payloads({f"k{i}": i for i in range(MOST_FIELDS + 1)}), "payload") is None
    # They are handled by the general expressions.
    spec = transform.TransformSpec(required=("a",), keys=("a",))
    valid, rejected = transform.transform(payloads({"a": 1}, "[1]", {'a"b': 1}), spec)
    assert valid.count() == 1 and sorted(r._validation_errors[0] for r in rejected.collect()) == ["Missing required field: a", "Record is not an object"]


def test_flattening_refuses_what_is_no_object(payloads):
    spec = transform.TransformSpec(flatten=True)
    for other in ("null", "3"):
        with pytest.raises(PySparkException, match="not an object"):
            transform.transform(payloads({"a": {"b": 1}}, other), spec)[0].collect()


def test_an_empty_input_has_a_shape(spark, payloads):
    rows = payloads({"a": 1}).where("ordinal < 0")
    valid, rejected = transform.transform(rows, transform.TransformSpec(required=("a",), keys=("a",)))
    assert valid.count() == rejected.count() == 0


def test_outputs_share_what_was_written_once(spark, payloads, tmp_path):
    rows = payloads({"id": "1", "v": " a "}, {"id": ""}, {"id": "1", "v": "b"})
    spec = transform.TransformSpec(required=("id",), keys=("id",))
    work = str(tmp_path / "work")
    valid, rejected = transform.transform(rows, spec, work=work)
    for df in (valid, rejected):
        assert work in df._jdf.queryExecution().executedPlan().toString()
    assert [json.loads(x) for x in as_texts(valid)] == [{"id": "1", "v": "a"}] and rejected.first()._record_index == 1


def test_the_last_in_the_text_stays(spark):
    texts = ['{"user_id": 1, "userId": 2}', '{"userId": 2, "user_id": 1}', '{"userId": 3}', '{"user_id": null, "userId": null, "User ID": 5}', '{"x": {"a-b": 1, "aB": 2}, "x_": 0}', '{"x": {"aB": 2, "a-b": 1, "aB": 9}}', '{"x": null}', '{"l": [{"aB": 1, "a-b": 2}]}', None]
    rows = spark.createDataFrame(list(enumerate(texts)), "ordinal int, text string").withColumn("payload", F.parse_json("text"))
    shape = shape_of(rows, "payload")
    done = as_texts(rows.withColumn("payload", normalize_known("payload", shape, text="text")))
    assert done == ['{"user_id":2}', '{"user_id":1}', '{"user_id":3}', '{"user_id":5}', '{"x":0}', '{"x":{"a_b":1}}', '{"x":null}', '{"l":[{"a_b":1}]}', None]
    # Without the text the order of keys decides: "User ID" < "userId" < "user_id".
    assert as_texts(rows.withColumn("payload", normalize_known("payload", shape)))[:3] == ['{"user_id":1}', '{"user_id":1}', '{"user_id":3}']


def test_flattened_fields_keep_the_order_of_the_text(spark):
    texts = ['{"a": {"b": 1}, "a_b": 2}', '{"a_b": 2, "a": {"b": 1}}', '{"A": {"c": 3, "C": 4}}', '{"A": {"C": 4, "c": 3}}']
    rows = spark.createDataFrame(list(enumerate(texts)), "ordinal int, text string").withColumn("payload", F.parse_json("text"))
    done = as_texts(rows.withColumn("payload", normalize_known("payload", shape_of(rows, "payload", True), text="text", flatten_depth=5)))
    assert done == ['{"a_b":2}', '{"a_b":1}', '{"a_c":4}', '{"a_c":3}']
