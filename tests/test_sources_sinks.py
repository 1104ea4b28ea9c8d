"""JSON lines, load history, pages, staging, tables and the two streams."""

import itertools
import json
import pathlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from millrace.functions import variants as V
from millrace.plans import runs
from millrace.session import spread, workspace
from millrace.sinks import stage as sink, tables
from millrace.sources import extract, jsonl, pages, stage
from millrace.specs import API_A
from millrace.streaming.landing import land, read_history, read_raw, read_rejected
from millrace.sinks.buckets import read_buckets
from millrace.streaming.upsert import stream_upsert


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_jsonl_blank_bad_and_repeated_keys(spark, tmp_path):
    path = _write(tmp_path / "a.jsonl", '{"a": 1, "a": 2}\n\n   \n{"b": null}\n')
    assert [r[0] for r in jsonl.read_jsonl(spark, path).select(F.to_json("payload")).collect()] == ['{"a":2}', '{"b":null}']
    bad = _write(tmp_path / "b.jsonl", '{"a": 1}\n{bad\n')
    with pytest.raises(Exception, match="MALFORMED"):
        jsonl.read_jsonl(spark, bad).collect()
    assert jsonl.read_jsonl(spark, bad, "continue").count() == 1


def test_missing_and_null_differ(payloads):
    df = payloads({"id": None}, {}).orderBy("ordinal")
    got = df.select(V.is_missing(F.col("payload"), "id"), V.is_json_null(F.col("payload"), "id")).collect()
    assert [tuple(r) for r in got] == [(False, True), (True, False)]


def test_load_history_finds_the_line_in_files_of_many_splits(spark, tmp_path):
    folder = tmp_path / "source=api_a" / "dt=2024-01-01" / "hour=00" / "batch_id=b1"
    lines = [json.dumps({"n": i, "pad": "x" * 80}) for i in range(3000)]
    lines[2345] = "{bad"
    lines[2900] = "{worse"
    lines[7] = " "
    _write(folder / "part-0001.jsonl", "\n".join(lines) + "\n")
    _write(folder / "part-0002.jsonl", '{"n": 1}\n')
    _write(folder / "part-0003.jsonl", "\n{no\n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        text = jsonl.text_lines(spark, str(tmp_path))
        assert text.rdd.getNumPartitions() > 5
        rows = {r.file_name[-15:]: r for r in jsonl.load_history(text).collect()}
        failed = [r.file_name[-15:] for r in jsonl.failed_loads(jsonl.load_history(text)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    first = rows["part-0001.jsonl"]
    assert (first.status, first.row_parsed, first.row_count, first.error_count) == ("Partially loaded", 2999, 2997, 2)
    assert first.first_error_line_number == 2346
    assert rows["part-0002.jsonl"].status == "Loaded" and rows["part-0002.jsonl"].first_error_message is None
    assert (rows["part-0003.jsonl"].status, rows["part-0003.jsonl"].first_error_line_number) == ("Load failed", 2)
    assert sorted(failed) == ["part-0001.jsonl", "part-0003.jsonl"]
    assert sorted(r.line for r in jsonl.load_errors(jsonl.text_lines(spark, str(tmp_path))).collect()) == ["{bad", "{no", "{worse"]
    # Landing records the same, with the time of the load.
    raw = str(tmp_path / "raw")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        land(spark, str(tmp_path), "api_a", raw, str(tmp_path / "seen"), "2024-01-05 06:00:00").awaitTermination()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    landed = {r.file_name[-15:]: r for r in read_history(spark, raw).collect()}
    for name, row in rows.items():
        assert landed[name][1:7] == row[1:7] and str(landed[name].last_load_time) == "2024-01-05 06:00:00"
    assert sorted(r.line for r in read_rejected(spark, raw).collect()) == ["{bad", "{no", "{worse"]
    assert read_raw(spark, raw).count() == 2998


def test_history_is_kept_per_load_and_read_without_payloads(spark, tmp_path):
    root, raw, seen = (str(tmp_path / n) for n in ("stage", "raw", "seen"))
    for n, at in enumerate(("2024-01-05", "2024-01-06")):
        _write(tmp_path / "stage" / "source=api_a" / "batch_id=b" / f"{n}.jsonl", '{"id": 1}\n\n{bad\n' if n else "\n \n")
        land(spark, root, "api_a", raw, seen, at).awaitTermination()
    rows = {r.load_id: r for r in read_history(spark, raw).collect()}
    assert (rows["0"].status, rows["0"].row_parsed, rows["0"].error_count) == ("Loaded", 0, 0)
    assert (rows["1"].status, rows["1"].row_parsed, rows["1"].first_error_line_number) == ("Partially loaded", 2, 3)
    assert str(rows["1"].last_load_time)[:10] == "2024-01-06" and jsonl.failed_loads(read_history(spark, raw)).count() == 1
    # A load that is repeated replaces its rows and its history.
    commits = tmp_path / "seen" / "commits" / "1"
    commits.unlink()
    commits.with_name(".1.crc").unlink(missing_ok=True)
    land(spark, root, "api_a", raw, seen, "2024-01-07").awaitTermination()
    assert read_raw(spark, raw).count() == 1 and read_history(spark, raw).count() == 2


def test_batch_ids_in_file_names(spark):
    name = F.lit("source=api_a/dt=2024-01-01/hour=09/batch_id=abc123/part-0001.jsonl")
    row = spark.range(1).select(jsonl.batch_of(name), jsonl.batch_of(name, legacy=True), jsonl.batch_of(F.lit("x"))).first()
    assert tuple(row) == ("abc123", "abc123/part-0001.jsonl", "")


PAGE = st.tuples(st.integers(0, 3), st.sampled_from(["c", "", None]), st.sampled_from([None, 0, 2, 5, 100]))


def _fetch(rows, kind):
    """The records a client would get by asking for one page after the other."""
    got = []
    for page, (n, cursor, total) in enumerate(rows):
        got += [(page, i) for i in range(n)]
        if n == 0 or (kind == "cursor" and not cursor) or (kind == "offset" and len(got) >= (total or 0)):
            break
    return got


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(PAGE, min_size=1, max_size=12), min_size=1, max_size=6), st.sampled_from(["cursor", "offset"]), st.sampled_from([2, 4096]))
def test_pages_end_where_a_client_would_stop(spark, fetches, kind, block):
    rows = []
    for fetch, items in enumerate(fetches):
        for page, (n, cursor, total) in enumerate(items):
            records = [{"p": page, "i": i} for i in range(n)]
            body = {"data": records, "meta": {"next_cursor": cursor}} if kind == "cursor" else {"items": records, "total": total}
            rows.append((fetch, page, json.dumps(body)))
    df = spark.createDataFrame(rows, "fetch_id int, page_no int, text string").select("fetch_id", "page_no", F.parse_json("text").alias("payload"))
    usual, pages.PAGE_BLOCK = pages.PAGE_BLOCK, block
    try:
        out = (pages.unnest_cursor if kind == "cursor" else pages.unnest_offset)(df)
        got = sorted((r.fetch_id, r.page_no, r.item_no) for r in out.collect())
    finally:
        pages.PAGE_BLOCK = usual
    assert got == sorted((f, p, i) for f, items in enumerate(fetches) for p, i in _fetch(items, kind))


def test_changed_since(spark):
    df = spark.sql("SELECT * FROM VALUES (timestamp_ntz'2024-01-01'), (timestamp_ntz'2024-01-02') AS t(ts)")
    counts = [extract.changed_since(df, "ts", *a).count() for a in ((None,), ("2024-01-01",), ("2024-01-01", True))]
    assert counts == [2, 1, 2]


def test_staging_layout(spark, payloads, tmp_path):
    root = str(tmp_path / "stage")
    rows = payloads({"id": "1", "n": None, "_batch_id": "own"}, {"id": "2"}).withColumn("batch", F.concat(F.lit("12e"), F.col("ordinal").cast("string")))
    report = sink.stage(rows, root, "api_a", F.col("batch"), "2024-01-05 09:30:00", payload="payload", schema_version="1.1")
    assert report["record_count"] == 2
    read = stage.read_staged(spark, root, "api_a").orderBy("batch_id")
    got = [(json.loads(r.j), r.dt, r.hour, r.batch_id) for r in read.select(F.to_json("payload").alias("j"), *stage.LAYOUT).collect()]
    at = {"_extracted_at": "2024-01-05T09:30:00.000000Z", "_schema_version": "1.1", "_source": "api_a"}
    # A field of the record wins over the batch column of that name, and null fields stay.
    assert got[0] == ({**at, "_batch_id": "own", "id": "1", "n": None}, "2024-01-05", "09", "12e0")
    assert got[1] == ({**at, "_batch_id": "12e1", "id": "2"}, "2024-01-05", "09", "12e1")
    plan = read.where("dt >= '2024-01-06'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "dt" in plan.split("PartitionFilters")[1]


def test_staging_a_batch_again_replaces_it_and_nothing_writes_nothing(spark, payloads, tmp_path):
    root = str(tmp_path / "stage")
    rows = payloads({"id": "1"}, {"id": "2"}).select("payload")
    for at in ("2024-01-05 09:00:00", "2024-01-05 09:00:00", "2024-01-05 10:00:00"):
        sink.stage(rows, root, "api_a", "b1", at, payload="payload")
    assert stage.staged_lines(spark, root).count() == 4
    before = sorted(str(p) for p in pathlib.Path(root).rglob("*.txt"))
    assert sink.stage(rows.limit(0), root, "api_a", "b2", "2024-01-05", payload="payload")["record_count"] == 0
    assert sorted(str(p) for p in pathlib.Path(root).rglob("*.txt")) == before
    assert not list(pathlib.Path(root).rglob("batch_id=b2"))


def test_typed_records_keep_nulls_and_microseconds(spark, tmp_path):
    df = spark.sql("SELECT 1 AS id, cast(null as string) AS n, timestamp_ntz'2024-01-01 00:00:00.123456' AS t, named_struct('u', timestamp_ntz'2024-01-01 00:00:00.000001') AS s")
    sink.write_jsonl(df, str(tmp_path / "j"), "b1", "2024-01-02")
    record = json.loads(spark.read.text(str(tmp_path / "j")).first()[0])
    assert record["n"] is None and record["t"] == "2024-01-01T00:00:00.123456Z" and record["s"] == {"u": "2024-01-01T00:00:00.000001Z"}
    assert list(record)[:3] == ["_batch_id", "_extracted_at", "_schema_version"]


def test_report_of_a_write(spark, tmp_path):
    path = str(tmp_path / "p")
    report = sink.write_parquet(spark.range(10).withColumn("_batch_id", F.lit("own")), path, "b1", "2024-01-02")
    row = sink.write_report(spark, report, "b1", "2024-01-02").first()
    assert row.record_count == 10
    assert row.file_size_bytes == sum(p.stat().st_size for p in pathlib.Path(path).glob("*.parquet"))
    assert {r[0] for r in spark.read.parquet(path).select("_batch_id").collect()} == {"own"}


def test_new_batch_ids(spark):
    ids = [r[0] for r in spark.range(50).select(sink.new_batch_id()).collect()]
    assert len(set(ids)) == 50 and all(len(i) == 12 and int(i, 16) >= 0 for i in ids)


def test_listing(spark, tmp_path):
    _write(tmp_path / "source=api_a" / "dt=2024-01-01" / "x.jsonl", "12345")
    row = stage.list_stage(spark, str(tmp_path)).first()
    assert (row.file_name, row.size) == ("source=api_a/dt=2024-01-01/x.jsonl", 5)
    assert stage.staging_path("/r/", "api_a", __import__("datetime").datetime(2024, 1, 2, 3), batch_id="b") == "/r/source=api_a/dt=2024-01-02/hour=03/batch_id=b"


def test_landing_loads_each_file_once(spark, tmp_path):
    root, raw, seen = (str(tmp_path / n) for n in ("stage", "raw", "seen"))
    folder = tmp_path / "stage" / "source=api_a" / "dt=2024-01-01" / "hour=00"
    _write(folder / "batch_id=b1" / "part-0001.jsonl", '{"id": 1}\n{bad\n\n{"id": 2}\n')

    def run(**kwargs):
        land(spark, root, "api_a", raw, seen, "2024-01-05", **kwargs).awaitTermination()
        return read_raw(spark, raw).count()

    assert [run(), run()] == [2, 2]
    _write(folder / "batch_id=b2" / "part-0001.jsonl", '{"id": 3}\n')
    _write(folder / "batch_id=b3" / "part-0001.jsonl", '{"id": 4}\n')
    assert run(max_files=1) == 4
    rows = read_raw(spark, raw).orderBy("batch_id", "file_name").collect()
    assert {r.batch_id for r in rows} == {"b1", "b2", "b3"} and {r.source for r in rows} == {"api_a"}
    assert rows[0].file_name == "source=api_a/dt=2024-01-01/hour=00/batch_id=b1/part-0001.jsonl"
    rejected = read_rejected(spark, raw).collect()
    assert [(r.line, r.file_name[-23:]) for r in rejected] == [("{bad", "batch_id=b1/part-0001.jsonl"[-23:])]


def test_raw_opens_only_the_ingest_days_it_needs(spark, tmp_path):
    root, raw, seen = (str(tmp_path / n) for n in ("stage", "raw", "seen"))
    for n, at in enumerate(("2024-01-05 10:00:00", "2024-01-06 01:00:00", "2024-01-06 23:00:00")):
        _write(tmp_path / "stage" / "source=api_a" / "x" / f"{n}.jsonl", json.dumps({"id": n}) + "\n")
        land(spark, root, "api_a", raw, seen, at).awaitTermination()
    late = read_raw(spark, raw, "2024-01-06 02:00:00")
    assert [str(r.ingested_at) for r in late.collect()] == ["2024-01-06 23:00:00"]
    assert late.columns == read_raw(spark, raw).columns and read_raw(spark, raw).count() == 3
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "isnotnull(ingest_day" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]


def test_landing_can_refuse_bad_lines(spark, tmp_path):
    _write(tmp_path / "stage" / "source=api_a" / "x" / "a.jsonl", "{bad\n")
    query = land(spark, str(tmp_path / "stage"), "api_a", str(tmp_path / "raw"), str(tmp_path / "seen"), on_error="fail")
    with pytest.raises(Exception, match="MALFORMED|bad"):
        query.awaitTermination()


def test_stream_upsert_survives_a_replay(spark, payloads, tmp_path):
    raw, out, seen = (str(tmp_path / n) for n in ("raw", "clean", "seen"))

    def load(n, *records):
        rows = payloads(*records).select(
            "payload", F.lit("api_a").alias("source"), F.lit(f"2024-01-0{n}").cast("timestamp_ntz").alias("ingested_at"),
            F.lit("b").alias("batch_id"), F.lit("f").alias("file_name"),
        )
        rows.write.parquet(f"{raw}/load_id={n}")

    def run():
        stream_upsert(spark, raw, out, seen, API_A, "2024-01-09").awaitTermination()
        return sorted((r.id or "", r.name) for r in read_buckets(spark, out, API_A).collect())

    load(1, {"id": "1", "updated_at": "2024-01-02", "name": "new"}, {"id": None, "name": "x"})
    assert run() == [("", "x"), ("1", "new")]
    load(2, {"id": "1", "updated_at": "2024-01-01", "name": "late"}, {"id": "2", "name": "y"}, {"id": None, "name": "z"})
    expected = [("", "x"), ("", "z"), ("1", "new"), ("2", "y")]
    assert run() == expected
    assert run() == expected
    # A batch that is replayed because its commit was lost finds its version and leaves it alone.
    commits = sorted((tmp_path / "seen" / "commits").glob("[0-9]*"))
    commits[-1].unlink()
    (tmp_path / "seen" / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert run() == expected


def test_work_folder_is_the_shared_one(spark):
    assert workspace(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_spread_leaves_large_inputs_alone(spark):
    assert spread(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 50)
    assert spread(many) is many


def test_a_whole_run(spark, payloads, tmp_path):
    layout = runs.Layout(str(tmp_path / "site"))
    a = [{"id": str(i % 4), "updatedAt": f"2024-01-0{1 + i // 4}", "createdAt": "2024-01-01"} for i in range(8)] + [{"name": "no id"}]
    b = [{"id": i, "modifiedAt": "2024-01-02", "amount": 1.5, "priority": "p"} for i in range(3)]

    def broken():
        raise OSError("no route")

    for hour, (sources, expected) in enumerate([(("api_a", "api_b"), [4, 3]), (("api_a", "broken"), [4, 3])]):
        inputs = {"api_a": lambda: payloads(*a), "api_b": (lambda: payloads(*b)) if sources[1] == "api_b" else broken}
        now = f"2024-01-05 0{hour}:30:00"
        outcome = runs.run_ingestion(spark, inputs, layout, batch_id=f"run{hour}", at=now)
        metrics = runs.run_hourly(spark, layout, outcome, f"run{hour}", now).first()
        assert metrics.total_checks == 8 and metrics.failed == 0
        assert metrics.status == ("success" if hour == 0 else "partial_failure")
        board = runs.dashboard(spark, layout, now).orderBy("source").collect()
        assert [r.total_records for r in board] == expected
    first = outcome.where("source = 'api_a'").first()
    assert (first.records_fetched, first.records_staged, first.records_rejected) == (9, 4, 1)
    assert "no route" in outcome.where("source = 'api_b'").first().error
    rows = list(itertools.chain(spark.read.parquet(layout.quarantine("api_a")).collect()))
    assert {r._validation_errors[0] for r in rows} == {"Missing required field: id"}


def test_purge_drops_expired_day_folders_only(spark, tmp_path):
    for folder in ("source=a/dt=2024-01-01", "source=a/dt=2024-03-01", "source=b/dt=2024-01-31", "source=b/dt=0", "other"):
        (tmp_path / folder / "hour=01").mkdir(parents=True)
        (tmp_path / folder / "hour=01" / "x.json").write_text("{}\n")
    assert tables.purge_expired(spark, str(tmp_path), "2024-03-02 00:00:00") == 2
    left = sorted(str(p.relative_to(tmp_path).parent.parent) for p in tmp_path.rglob("x.json"))
    assert left == ["other", "source=a/dt=2024-03-01", "source=b/dt=0"]
    assert tables.purge_expired(spark, str(tmp_path), "2024-03-02 00:00:00") == 0
