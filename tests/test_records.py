"""Flatten, normalise, validate, dedupe and their composition."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators.dedupe import dedupe, latest_per_key
from millrace.operators.flatten import flatten_records, flatten_struct, struct_type_of, type_payload
from millrace.operators.normalize import key_report, normalize_struct, normalize_variant
from millrace.operators.validate import ValidationError, split_valid, with_validation_errors
from millrace.plans.transform import TransformSpec, dedupe_payload, transform, transform_source

READING = {
    "probe": {"serial": "T-77", "site": {"floor": 3, "hall": {"row": "K", "slot": 12, "lit": False}}},
    "samples": [{"deg": 20.5, "at": [1, 2]}, "gap"],
    "ok": True,
}


@pytest.mark.parametrize(
    "record, kwargs, expected",
    [
        ({"tide": {"high": "06:10", "low": None}, "port": 4}, {}, {"tide_high": "06:10", "tide_low": None, "port": 4}),
        ({"tide": {"high": [1]}}, {"sep": "/"}, {"tide/high": [1]}),
        ({"w": {"x": {"y": {"z": {"q": 0}}}}}, {"max_depth": 3}, {"w_x_y_z": {"q": 0}}),
        ({"w": {"x": 5}, "v": 6}, {"max_depth": 0}, {"w": {"x": 5}, "v": 6}),
        ({"p": {}, "q": {"r": {}}, "s": None, "t": []}, {}, {"s": None, "t": []}),
        ({"": {"a": 1}, "b": {"": 2}}, {}, {"a": 1, "b_": 2}),
        ({"m": {"n": "deep"}, "m_n": "plain"}, {}, {"m_n": "plain"}),
        ({"rows": [[{"k": {"v": 1}}]]}, {}, {"rows": [[{"k": {"v": 1}}]]}),
        (
            READING,
            {},
            {
                "ok": True,
                "probe_serial": "T-77",
                "probe_site_floor": 3,
                "probe_site_hall_lit": False,
                "probe_site_hall_row": "K",
                "probe_site_hall_slot": 12,
                "samples": READING["samples"],
            },
        ),
    ],
)
def test_flatten(payloads, records, record, kwargs, expected):
    assert records(flatten_records(payloads(record), **kwargs)) == [expected]


def test_flatten_keeps_every_record_and_fails_on_a_bad_one(payloads, records):
    assert records(flatten_records(payloads({"id": 1}, {"id": 2}, {}))) == [{"id": 1}, {"id": 2}, {}]
    with pytest.raises(PySparkException, match="not an object"):
        flatten_records(payloads({"id": 1}, "[1]")).collect()


def test_flatten_of_typed_columns(payloads):
    df = payloads(READING, {"ok": None, "probe": {"serial": "T-78"}})
    assert "hall: STRUCT" in struct_type_of(df, "payload")
    flat = flatten_struct(type_payload(df, "payload").drop("ordinal"))
    assert sorted(flat.columns) == ["ok", "probe_serial", "probe_site_floor", "probe_site_hall_lit", "probe_site_hall_row", "probe_site_hall_slot", "samples"]
    assert {r.probe_serial: r.probe_site_hall_slot for r in flat.collect()} == {"T-77": 12, "T-78": None}
    shallow = flatten_struct(type_payload(df, "payload"), max_depth=1)
    assert shallow.schema["probe_site"].dataType.typeName() == "struct"


def test_typed_collision_keeps_the_last_column(spark):
    df = spark.sql("SELECT named_struct('b', 1) AS a, 2 AS a_b")
    assert flatten_struct(df).first().asDict() == {"a_b": 2}


@pytest.mark.parametrize(
    "record, expected",
    [
        ({"userName": "  x "}, {"user_name": "x"}),
        ({"createdAt": "2024-01-15", "n": 1.5, "b": True}, {"created_at": "2024-01-15T00:00:00.000000Z", "n": 1.5, "b": True}),
        ({"createdAt": {"a": 1}}, {"created_at": None}),
        ({"createdAt": True}, {"created_at": None}),
        ({"a": {"createdAt": 0, "l": [{"createdAt": "x"}, " s ", 1, [" t ", {"aB": 1}]]}},
         {"a": {"created_at": "1970-01-01T00:00:00.000000Z", "l": [{"created_at": None}, " s ", 1, [" t ", {"aB": 1}]]}}),
        ({"a": [], "b": {}, "c": None, "d": [[]], "e": [{}]}, {"a": [], "b": {}, "c": None, "d": [[]], "e": [{}]}),
        ({"!!": 1, "ok": 2}, {"ok": 2}),
        ({"userId": 1, "user_id": 2}, {"user_id": 2}),
        ({}, {}),
    ],
)
def test_normalize(payloads, records, record, expected):
    done = payloads(record).withColumn("payload", normalize_variant("payload", ["created_at"]))
    assert records(done) == [expected]


def test_keys_may_stay(payloads, records):
    done = payloads({"camelCase": " v ", "createdAt": "2024-01-15"}).withColumn(
        "payload", normalize_variant("payload", ["createdAt"], normalize_keys=False)
    )
    assert records(done) == [{"camelCase": "v", "createdAt": "2024-01-15T00:00:00.000000Z"}]


def test_what_is_deeper_than_the_limit_raises(payloads, records):
    df = payloads({"a": {"b": {"c": " x "}}})
    assert records(df.withColumn("payload", normalize_variant("payload", max_depth=3))) == [{"a": {"b": {"c": "x"}}}]
    with pytest.raises(PySparkException, match="max_depth"):
        df.select(normalize_variant("payload", max_depth=2)).collect()


def test_key_report(payloads):
    df = payloads({"userId": 1, "user_id": 2}, {"userId": 1, "?": 0}, {"fine": 1})
    rows = {r.name: (r.spellings, r.first_spelling, r.last_spelling, r.occurrences) for r in key_report(df).collect()}
    assert rows == {"user_id": (2, "userId", "user_id", 3), "": (1, "?", "?", 1)}


def test_normalize_typed_columns(spark):
    df = spark.sql(
        "SELECT ' x ' AS userName, 1705315800 AS createdAt, array(named_struct('subKey', ' y ', 'in', array(named_struct('aB', ' z')))) AS l,"
        " array(' keep ') AS tags, named_struct('createdAt', '2024-01-15') AS o, cast(null as struct<aB: string>) AS missing"
    )
    row = json.loads(normalize_struct(df, ["created_at"]).select(F.to_json(F.struct("*"))).first()[0])
    assert row == {
        "user_name": "x",
        "created_at": "2024-01-15T10:50:00.000000Z",
        "l": [{"sub_key": "y", "in": [{"a_b": "z"}]}],
        "tags": [" keep "],
        "o": {"created_at": "2024-01-15T00:00:00.000000Z"},
    }


def test_validation_errors_in_field_order(payloads):
    df = payloads({"id": "1", "name": "n"}, {"id": None}, {"id": "1", "name": "  "}, {"id": 0, "name": False}, {"id": [], "name": {}})
    rows = with_validation_errors(df, ["id", "name"], "payload").orderBy("ordinal").collect()
    assert [r._validation_errors for r in rows] == [
        [],
        ["Null value for required field: id", "Missing required field: name"],
        ["Empty value for required field: name"],
        [],
        [],
    ]


def test_split_keeps_errors_and_position(payloads):
    df = payloads({"tag": ""}, {"tag": "red", "size": 4}, {"size": 2}, {"tag": "blue", "size": None}, {"tag": 0, "size": 0})
    valid, rejected = split_valid(df, ["tag", "size"], "payload", index="ordinal")
    assert [r.ordinal for r in valid.orderBy("ordinal").collect()] == [1, 4]
    assert {r._record_index: r._validation_errors for r in rejected.collect()} == {
        0: ["Empty value for required field: tag", "Missing required field: size"],
        2: ["Missing required field: tag"],
        3: ["Null value for required field: size"],
    }
    with pytest.raises(ValidationError) as caught:
        split_valid(df, ["tag", "size"], "payload", raise_on_error=True, index="ordinal")
    assert caught.value.errors == ["Empty value for required field: tag", "Missing required field: size"]
    split_valid(df.where("ordinal in (1, 4)"), ["tag"], "payload", raise_on_error=True)


def test_validation_of_typed_columns(spark):
    df = spark.createDataFrame([("a", None), ("  ", 0)], "name string, n int")
    rows = with_validation_errors(df, ["name", "n", "gone"]).collect()
    assert [r._validation_errors for r in rows] == [
        ["Null value for required field: n", "Missing required field: gone"],
        ["Empty value for required field: name", "Missing required field: gone"],
    ]


VERSIONS = [(0, "1", "2024-01-01", "old"), (1, "1", "2024-01-03", "new"), (2, "1", "2024-01-03", "tie"), (3, "2", None, "none"), (4, "2", "", "blank"), (5, None, "2024-01-01", "nokey")]


@pytest.mark.parametrize(
    "kwargs, expected",
    [
        ({"sort": "at", "keep": "last"}, {"new", "none"}),
        ({"sort": "at", "keep": "first"}, {"old", "none"}),
        ({"keep": "last"}, {"old", "none"}),
        ({"sort": "at", "null_keys": "collapse"}, {"new", "none", "nokey"}),
    ],
)
def test_dedupe(spark, kwargs, expected):
    df = spark.createDataFrame(VERSIONS, "n int, id string, at string, v string")
    assert {r.v for r in dedupe(df, ["id"], tie_break=["n"], **kwargs).collect()} == expected


def test_dedupe_by_several_keys_and_of_nothing(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, "a", 1)], "n int, k string, j int")
    assert sorted(r.n for r in dedupe(df, ["k", "j"], tie_break=["n"]).collect()) == [0, 1]
    assert dedupe(df.limit(0), ["k"], "j").collect() == []
    assert latest_per_key(df, "k", "j").first().n == 1


def test_dedupe_refuses_what_it_can_not_decide(spark):
    df = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="tie_break"):
        dedupe(df, ["id"])
    with pytest.raises(ValueError, match="keep"):
        dedupe(df, ["id"], "id", keep="middle")


def test_payload_keys_compare_with_their_type(payloads, records):
    df = payloads({"id": "1"}, {"id": 1}, {"id": 1.0}, {"id": None}, {})
    assert records(dedupe_payload(df, ["id"])) == [{"id": "1"}, {"id": 1}]


def test_transform_runs_all_steps(payloads, records):
    df = payloads(
        {"id": "1", "Name": " a ", "createdAt": "2024-01-15T10:00:00Z", "o": {"x": 1}},
        {"id": "1", "Name": "b", "createdAt": "2024-01-16T10:00:00Z"},
        {"id": "2", "Name": None, "createdAt": "2024-01-15"},
    )
    spec = TransformSpec(("id", "name"), ("created_at",), ("id",), "created_at", flatten=True)
    valid, rejected = transform(df, spec)
    assert records(valid) == [{"id": "1", "name": "b", "created_at": "2024-01-16T10:00:00.000000Z"}]
    assert [(r._record_index, r._validation_errors) for r in rejected.collect()] == [(2, ["Null value for required field: name"])]
    all_valid, none = transform(df, TransformSpec())
    assert (all_valid.count(), none.count()) == (3, 0)


def test_source_presets(payloads, records):
    rows = [{"id": "1", "modifiedAt": "2024-01-02", "updatedAt": "2024-01-01"}, {"id": "1", "modifiedAt": "2024-01-01", "updatedAt": "2024-01-02"}]
    assert records(transform_source(payloads(*rows), "api_b")[0])[0]["modified_at"].startswith("2024-01-02")
    assert records(transform_source(payloads(*rows), "api_a")[0])[0]["updated_at"].startswith("2024-01-02")
