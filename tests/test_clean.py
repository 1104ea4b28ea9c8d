"""RAW to CLEAN: casts, full rebuild, incremental slice, upsert."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.operators import clean, governance
from millrace.operators.merge import merge_newer, merge_newer_small
from millrace.sinks import tables
from millrace.specs import API_A, API_B


@pytest.fixture
def raw_of(spark):
    """RAW rows of (payload text, ingested_at)."""

    def make(*rows, source="api_a"):
        df = spark.createDataFrame([(i, t, at) for i, (t, at) in enumerate(rows)], "ordinal bigint, text string, at string")
        return df.select(
            F.parse_json("text").alias("payload"), F.lit(source).alias("source"), F.col("at").cast("timestamp_ntz").alias("ingested_at"),
            F.lit("b").alias("batch_id"), F.lit("f").alias("file_name"), "ordinal",
        )

    return make


def test_fields_are_typed(raw_of):
    text = (
        '{"id": 7, "created_at": "2024-01-15T10:30:00+05:00", "updated_at": "2024-01-15 10:30:00", "type": "t", "value": "2.5",'
        ' "metadata": {"category": "c", "tags": ["a", 1, {"x": 1}]}}'
    )
    row = clean.clean_full(raw_of((text, "2024-01-16")), API_A, "2024-01-17").first()
    assert row.id == "7" and row.event_type == "t" and row.category == "c"
    assert row.created_at == dt.datetime(2024, 1, 15, 10, 30)
    assert int(row.value) == 3
    assert row.tags == ["a", "1", '{"x":1}']
    assert row.name is None and row._loaded_at == dt.datetime(2024, 1, 17)
    assert list(row.asDict()) == API_A.clean_columns


def test_misfits_raise_turn_null_or_are_set_aside(raw_of):
    raw = raw_of(('{"id": "1", "value": "abc"}', "2024-01-01"), ('{"id": "2", "value": null}', "2024-01-01"))
    with pytest.raises(PySparkException):
        clean.project(raw, API_A).collect()
    assert [r.value for r in clean.project(raw, API_A, on_error="null").collect()] == [None, None]
    fits, aside = clean.split_castable(raw, API_A)
    assert [r._cast_errors for r in aside.collect()] == [["value"]]
    assert clean.project(fits, API_A).first().id == "2"


def test_full_rebuild_keeps_one_null_key_and_ranks_null_versions_last(raw_of):
    raw = raw_of(
        ('{"id": "a"}', "2024-01-01"), ('{"id": "a", "updated_at": "2024-01-01"}', "2024-01-01"),
        ('{"name": "x"}', "2024-01-01"), ('{"id": null, "name": "y"}', "2024-01-01"),
    )
    rows = clean.clean_full(raw, API_A, tie_break=["ordinal"]).collect()
    assert sorted((r.id or "", r.updated_at is None, r.name) for r in rows) == [("", True, "x"), ("a", False, None)]


def test_slice_starts_after_the_last_load(raw_of, spark):
    raw = raw_of(*[(f'{{"id": "{i}"}}', f"2024-01-0{i}") for i in range(1, 6)])
    loaded = clean.clean_full(raw.where("ordinal < 2"), API_A, "2024-01-03")
    assert sorted(r.id for r in clean.incremental_slice(raw, loaded, API_A).collect()) == ["4", "5"]
    empty = spark.createDataFrame([], API_A.clean_schema)
    assert clean.incremental_slice(raw, empty, API_A).count() == 5


def _versions(spark, rows):
    return spark.createDataFrame(rows, "id string, updated_at int, who string")


TARGET = [("a", 1, "t"), ("b", 5, "t"), (None, 1, "t"), ("n", None, "t"), ("only", 1, "t"), ("same", 3, "t"), ("m", 4, "t")]
SOURCE = [("a", 2, "s"), ("b", 4, "s"), (None, 9, "s"), ("n", 7, "s"), ("new", 1, "s"), ("same", 3, "s"), ("m", None, "s")]
MERGED = {("a", 2, "s"), ("b", 5, "t"), (None, 1, "t"), (None, 9, "s"), ("n", None, "t"), ("only", 1, "t"), ("new", 1, "s"), ("same", 3, "t"), ("m", 4, "t")}


@pytest.mark.parametrize("merge", [merge_newer, merge_newer_small])
def test_merge(spark, merge):
    rows = merge(_versions(spark, TARGET), _versions(spark, SOURCE), "id", "updated_at").collect()
    assert {tuple(r) for r in rows} == MERGED and len(rows) == len(MERGED)


@pytest.mark.parametrize("merge", [merge_newer, merge_newer_small])
def test_merge_with_an_empty_side(spark, merge):
    t, s = _versions(spark, TARGET), _versions(spark, SOURCE)
    assert {tuple(r) for r in merge(t, s.limit(0), "id", "updated_at").collect()} == set(TARGET)
    assert {tuple(r) for r in merge(t.limit(0), s, "id", "updated_at").collect()} == set(SOURCE)


def test_null_keys_do_not_meet_in_one_task(spark):
    rows = spark.range(4000).select(F.when(F.col("id") < 0, "x").alias("id"), F.col("id").cast("int").alias("updated_at"), F.lit("t").alias("who"))
    merged = merge_newer(rows, _versions(spark, SOURCE), "id", "updated_at")
    assert merged.count() == 4000 + len(SOURCE)
    spread = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sizes = merged.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", spread)
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2000


@pytest.mark.parametrize("limit", [tables.BROADCAST_ROWS, -1])
def test_upserts_of_any_split_equal_a_full_rebuild(spark, raw_of, tmp_path, monkeypatch, limit):
    """Both ways to merge, over random splits with distinct versions."""
    monkeypatch.setattr(tables, "BROADCAST_ROWS", limit)
    rng = random.Random(5)
    rows = [(f'{{"id": "{rng.randrange(12)}", "updated_at": "2024-01-01 00:00:{i:02d}", "name": "{i}"}}', i) for i in range(60)]
    rng.shuffle(rows)
    cuts = [0, 10, 35, 60]
    path = str(tmp_path / "clean")
    all_rows = []
    for load in range(3):
        all_rows += [(text, f"2024-02-0{load + 1} 00:00:00") for text, _ in rows[cuts[load] : cuts[load + 1]]]
        tables.upsert(raw_of(*all_rows), path, API_A, f"2024-02-0{load + 1} 12:00:00")
    upserted = tables.read_table(spark, path, API_A.clean_schema)
    full = clean.clean_full(raw_of(*all_rows), API_A)
    assert {(r.id, r.name) for r in upserted.collect()} == {(r.id, r.name) for r in full.collect()}
    assert upserted.count() == full.count()


def test_upsert_again_changes_nothing(spark, raw_of, tmp_path):
    path, raw = str(tmp_path / "clean"), raw_of(('{"id": "1", "modified_at": "2024-01-01", "amount": 1.005}', "2024-01-02"), source="api_b")
    for _ in range(3):
        tables.upsert(raw, path, API_B, "2024-01-03")
    assert [str(r.amount) for r in tables.read_table(spark, path, API_B.clean_schema).collect()] == ["1.01"]
    assert tables.versions(spark, path) == [1, 2]


def test_unfinished_versions_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/version=1")
    (tmp_path / "t" / "version=1" / "_SUCCESS").unlink()
    assert tables.read_table(spark, path, "id bigint").count() == 3
    tables.replace_table(spark.range(5), path)
    assert tables.read_table(spark, path, "id bigint").count() == 5


def test_drift_ignores_case(raw_of, spark):
    raw = raw_of(('{"id": 1, "new_field": 1, "ID": 2}', "2024-01-10"), ('{"old": 1}', "2024-01-01"))
    known = spark.createDataFrame([], "id string, name string")
    rows = [(r.raw_field, r.status) for r in governance.schema_drift(raw, known, "2024-01-10 12:00:00").collect()]
    assert rows == [("new_field", "NEW"), ("ID", "EXISTS"), ("id", "EXISTS")]


def test_retention(raw_of):
    raw = raw_of(('{"id": 1}', "2024-01-01"), ('{"id": 2}', "2024-04-01"))
    assert governance.retained(raw, "raw", "2024-04-10").count() == 1
    assert governance.retained(raw, "clean", "2034-04-10").count() == 2
