"""Keys, blanks, masking, time arithmetic and timestamp spellings."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import timefn
from millrace.functions.text import WHITESPACE, mask_email, snake_key, snake_name, trim_ws

KEYS = {
    "camelCase": "camel_case",
    "key-name": "key_name",
    "key name": "key_name",
    "key@name!": "keyname",
    "someAPIKey": "some_apikey",
    "__Hidden__": "hidden",
    "a--b  c": "a_b_c",
    "Already_snake": "already_snake",
    "fine_key_2": "fine_key_2",
    "a__b": "a_b",
    "x y": "x_y",
    "résumé": "rsum",
    "!!!": "",
}


def test_snake_keys(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string").select("k", snake_key("k").alias("s"))
    assert {r.k: r.s for r in df.collect()} == KEYS
    assert {k: snake_name(k) for k in KEYS} == KEYS


def test_acronyms_can_be_split(spark):
    assert snake_name("someAPIKey", split_acronyms=True) == "some_api_key"
    df = spark.createDataFrame([("someAPIKey",)], "k string")
    assert df.select(snake_key("k", split_acronyms=True)).first()[0] == "some_api_key"


def test_trim_strips_what_python_strips(spark):
    every = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    assert sorted(every) == sorted(WHITESPACE)
    texts = [f"{w}a {w} b{w}{w}" for w in every] + ["", " ", "x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", trim_ws(F.col("t")).alias("t"))
    assert {r.i: r.t for r in df.collect()} == {i: t.strip() for i, t in enumerate(texts)}


def test_mask_depends_on_role(spark):
    df = spark.createDataFrame([("joe@x.com",), (None,), ("no address",)], "e string")
    assert [r[0] for r in df.select(mask_email(F.col("e"), "ANALYST_ROLE")).collect()] == ["***@x.com", None, "no address"]
    assert [r[0] for r in df.select(mask_email(F.col("e"), "LOADER_ROLE")).collect()] == ["joe@x.com", None, "no address"]


@pytest.mark.parametrize(
    "unit, start, end, expected",
    [
        ("hour", "10:59:00", "11:01:00", 1),
        ("minute", "10:59:59", "11:00:01", 1),
        ("hour", "11:01:00", "10:59:00", -1),
        ("minute", "10:00:00", "10:00:59", 0),
    ],
)
def test_boundary_diff(spark, unit, start, end, expected):
    a, b = (F.lit(f"2024-03-01 {t}").cast("timestamp_ntz") for t in (start, end))
    assert spark.range(1).select(timefn.boundary_diff(unit, a, b)).first()[0] == expected


def test_boundary_diff_over_days_in_any_zone(spark):
    a, b = (F.lit(t).cast("timestamp_ntz") for t in ("2024-03-30 23:59:59", "2024-04-01 00:00:00"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        row = spark.range(1).select(*[timefn.boundary_diff(u, a, b) for u in ("day", "hour", "minute")]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (2, 25, 24 * 60 + 1)


SPELLINGS = {
    "2024-01-15T10:30:00Z": "2024-01-15T10:30:00.000000Z",
    "2024-01-15T10:30:00.12Z": "2024-01-15T10:30:00.120000Z",
    "2024-01-15t10:30:00z": "2024-01-15T10:30:00.000000Z",
    # The wall clock stays, the offset goes.
    "2024-01-15T10:30:00+05:00": "2024-01-15T10:30:00.000000Z",
    "2024-01-15T10:30:00.5-0730": "2024-01-15T10:30:00.500000Z",
    "2024-01-15T10:30:00": None,
    "2024-01-15 10:30:00": "2024-01-15T10:30:00.000000Z",
    "2024-01-15  10:30:00.123456": "2024-01-15T10:30:00.123456Z",
    "2024-01-15 10:30:00.1234567": None,
    "2024-1-5": "2024-01-05T00:00:00.000000Z",
    "2024-01- 5": "2024-01-05T00:00:00.000000Z",
    "2024-02-30": None,
    "0000-01-01": None,
    "05/01/2024 10:00:00": "2024-01-05T10:00:00.000000Z",
    "12/31/2024 10:00:00": "2024-12-31T10:00:00.000000Z",
    "31/02/2024 10:00:00": None,
    "13/25/2024 01:02:03": None,
    "2024-01-15T24:00:00Z": None,
    "2024-01-15T10:30:60Z": None,
    "2024-01-15T10:30:00+24:00": None,
    " 2024-01-15": None,
    "not a timestamp": None,
    "": None,
}


def test_spellings(spark):
    df = spark.createDataFrame([(t,) for t in SPELLINGS], "t string").select("t", timefn.normalize_ts("t").alias("n"))
    assert {r.t: r.n for r in df.collect()} == SPELLINGS


def test_offsets_can_be_applied(spark):
    texts = {
        "2024-01-15T10:30:00+05:30": "2024-01-15T05:00:00.000000Z",
        "2024-01-15T10:30:00.5-0730": "2024-01-15T18:00:00.500000Z",
        "2024-01-15T10:30:00+01:00:30": "2024-01-15T09:29:30.000000Z",
        "2024-01-15T10:30:00Z": "2024-01-15T10:30:00.000000Z",
        "2024-01-15 10:30:00": "2024-01-15T10:30:00.000000Z",
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", timefn.normalize_ts("t", to_utc=True).alias("n"))
    assert {r.t: r.n for r in df.collect()} == texts


EPOCHS = {
    1705315800.0: "2024-01-15T10:50:00.000000Z",
    1705315800000.0: "2024-01-15T10:50:00.000000Z",
    1705315800123.0: "2024-01-15T10:50:00.123000Z",
    0.0: "1970-01-01T00:00:00.000000Z",
    -1.0: "1969-12-31T23:59:59.000000Z",
    -1.5: "1969-12-31T23:59:58.500000Z",
    # The last number of seconds, and the first of milliseconds.
    32503680000.0: "3000-01-01T00:00:00.000000Z",
    32503680001.0: "1971-01-12T04:48:00.001000Z",
    1705315800000000.0: None,
    -99999999999999.0: None,
}


def test_epochs(spark):
    df = spark.createDataFrame([(x,) for x in EPOCHS], "x double").select("x", timefn.normalize_ts("x", "double").alias("n"))
    assert {r.x: r.n for r in df.collect()} == EPOCHS


def test_other_types_have_no_normal_form(spark):
    row = spark.sql("SELECT true AS b, timestamp_ntz'2024-01-15 10:30:00' AS t, date'2024-01-15' AS d")
    got = row.select(*[timefn.normalize_ts(c, k) for c, k in (("b", "boolean"), ("t", "timestamp_ntz"), ("d", "date"))]).first()
    assert tuple(got) == (None, "2024-01-15T10:30:00.000000Z", "2024-01-15T00:00:00.000000Z")


def test_variant_values_and_reasons(payloads):
    df = payloads({"t": "2024-01-15"}, {"t": 1705315800}, {"t": "x"}, {"t": 1e18}, {"t": True}, {"t": [1]}, {"t": None}, {})
    v = df.select("ordinal", F.variant_get("payload", "$.t", "variant").alias("v"))
    kind = F.expr("schema_of_variant(v)")
    rows = v.withColumn("kind", kind).select(
        "ordinal", F.expr(timefn.normalize_ts_variant("v", "kind")).alias("n"), timefn.ts_error("v").alias("e")
    )
    got = [(r.n and r.n[:10], r.e) for r in rows.orderBy("ordinal").collect()]
    assert got == [
        ("2024-01-15", None),
        ("2024-01-15", None),
        (None, "unknown timestamp spelling"),
        (None, "epoch out of range"),
        (None, "not a timestamp"),
        (None, "not a timestamp"),
        (None, None),
        (None, None),
    ]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(dt.datetime(1000, 1, 1), dt.datetime(9999, 12, 31)), min_size=1, max_size=200))
def test_any_time_survives_its_spellings(spark, times):
    forms = [("%Y-%m-%dT%H:%M:%S.%fZ", {}), ("%Y-%m-%d %H:%M:%S", {"microsecond": 0}), ("%d/%m/%Y %H:%M:%S", {"microsecond": 0})]
    rows = [
        (t.strftime(form), t.replace(**cut).isoformat(timespec="microseconds") + "Z") for t in times for form, cut in forms
    ]
    df = spark.createDataFrame(rows, "text string, expected string").select("expected", timefn.normalize_ts("text").alias("n"))
    assert df.where("n IS DISTINCT FROM expected").count() == 0
