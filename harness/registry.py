"""One query per operator. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StructField, StructType

from harness import adapters as D
from harness.adapters import AS_OF, table
from millrace.functions import timefn, variants as V
from millrace.functions.text import trim_ws
from millrace.operators.days import INGEST_DAY
from millrace.operators import clean, dedupe as dd, flatten, governance, merge, normalize, validate
from millrace.plans import analytics, metrics, quality, roles, runs, sketches, transform
from millrace.session import spread, workspace
from millrace.sinks import buckets, raw as raw_sink, stage as stage_sink, tables
from millrace.sources import extract, jsonl, links, pages, stage as stage_source
from millrace.specs import API_A, API_B, LINEAGE, SOURCES
from millrace.streaming import landing, upsert as upsert_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and lists as text, so that both engines print them alike."""
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.simpleString(), F.col(f.name)
        if kind.startswith("decimal"):
            c = c.cast("double")
        elif kind == "array<string>":
            c = F.array_join(c, ", ")
        out.append(c.alias(f.name))
    return df.select(out)


def text_of(v) -> F.Column:
    return F.to_json(v)


# Sources


def _write_lines(spark: SparkSession, lines: DataFrame, purpose: str) -> str:
    path = workspace(spark, purpose)
    lines.write.text(path)
    return path


@query
def read_jsonl(spark, sf_dir):
    """JSON lines with blank lines among them."""
    line = F.when(F.col("event_id") % 50 == 0, F.lit("  ")).otherwise(D.json_a())
    path = _write_lines(spark, table(spark, sf_dir, "events").select(line.alias("value")), "lines")
    rows = jsonl.read_jsonl(spark, path)
    return rows.select(
        V.field(F.col("payload"), "id", "string").alias("id"),
        V.field(F.col("payload"), "updated_at", "timestamp_ntz").alias("updated_at"),
        V.field(F.col("payload"), ("metadata", "category"), "string").alias("category"),
    )


def _stage_events(spark, sf_dir, part=None) -> str:
    """All events staged as JSON lines, one batch per day."""
    events = spread(table(spark, sf_dir, "events"))
    rows = events.select(
        F.parse_json(D.json_a()).alias("payload"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"),
        F.date_format("ts", "yyyyMMdd").alias("batch"),
    )
    root = part or workspace(spark, "stage")
    stage_sink.stage(rows, root, "api_a", F.col("batch"), F.col("day"), payload="payload")
    return root


def _raw_view(raw: DataFrame, clock: str) -> DataFrame:
    return raw.select(
        V.field(F.col("payload"), "id", "string").alias("id"),
        V.field(F.col("payload"), clock, "timestamp_ntz").alias(clock),
        "source",
        "batch_id",
        F.regexp_extract("file_name", r"^(source=.*)/[^/]*$", 1).alias("folder"),
    )


@query
def land_raw_a(spark, sf_dir):
    """Land staged files; the second call finds nothing new."""
    root, raw, seen = _stage_events(spark, sf_dir), workspace(spark, "raw"), workspace(spark, "offsets")
    for _ in range(2):
        landing.land(spark, root, "api_a", raw, seen, AS_OF).awaitTermination()
    return _raw_view(landing.read_raw(spark, raw), "updated_at")


@query
def land_refresh(spark, sf_dir):
    """Land, stage a second source folder's worth of new batches, land again: rows per load."""
    root, raw, seen = workspace(spark, "stage"), workspace(spark, "raw"), workspace(spark, "offsets")
    events = table(spark, sf_dir, "events")
    for new in (F.col("ts") < D.SPLIT_A, F.col("ts") >= D.SPLIT_A):
        rows = events.where(new).select(F.parse_json(D.json_a()).alias("payload"), F.date_format("ts", "yyyyMMdd").alias("batch"))
        stage_sink.stage(rows, root, "api_a", F.col("batch"), AS_OF, payload="payload")
        landing.land(spark, root, "api_a", raw, seen, AS_OF).awaitTermination()
    loads = spark.read.parquet(raw).groupBy("load_id").agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("batch_id").alias("batches"))
    return loads.select(F.col("load_id").cast("bigint").alias("load_id"), "row_count", "batches")


def _order_lines(spark, sf_dir) -> str:
    """Orders staged as JSON lines, one file per month in their order; every 50th is cut short and every 60th is blank."""
    n = F.col("o_orderkey")
    good = D.json_text(id=n.cast("string"), modified_at=D.stamp("o_orderdate"), state=F.col("o_orderstatus"))
    line = F.when(n % 50 == 0, F.concat(F.lit('{"id": '), n.cast("string"))).when(n % 60 == 1, F.lit("")).otherwise(good)
    root = workspace(spark, "stage")
    # The writer keeps the order of the rows only where it finds them sorted by all of its folders. A folder column that
    # is a constant drops out of the sort, and one that may be null is replaced; either way it sorts anew, by folders alone.
    text = lambda at, form, otherwise: F.coalesce(F.date_format(at, form), F.lit(otherwise))
    lines = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        line.alias("value"),
        text("o_orderdate", "yyyy-MM", "").alias("dt"),
        text(F.date_trunc("day", "o_orderdate"), "HH", "00").alias("hour"),
        text("o_orderdate", "yyyyMM", "").alias("batch_id"),
    )
    folders = stage_source.LAYOUT[1:]
    files = lines.repartition(*folders).sortWithinPartitions(*folders, "o_orderkey").drop("o_orderkey")
    files.write.partitionBy(*folders).text(f"{root}/source=api_b")
    return root


@query
def land_raw_b(spark, sf_dir):
    """Land files with bad and blank lines, some files per micro-batch."""
    root, raw = _order_lines(spark, sf_dir), workspace(spark, "raw")
    landing.land(spark, root, "api_b", raw, workspace(spark, "offsets"), AS_OF, max_files=50).awaitTermination()
    return _raw_view(landing.read_raw(spark, raw), "modified_at")


def _landed_orders(spark, sf_dir) -> str:
    raw = workspace(spark, "raw")
    landing.land(spark, _order_lines(spark, sf_dir), "api_b", raw, workspace(spark, "offsets"), AS_OF).awaitTermination()
    return raw


@query
def load_history(spark, sf_dir):
    """What landing recorded of each file, one per batch, with the line of its first error and the time of the load."""
    history = landing.read_history(spark, _landed_orders(spark, sf_dir))
    return history.select(jsonl.batch_of(F.col("file_name")).alias("batch_id"), *[c for c in history.columns if c not in ("file_name", "load_id")])


@query
def load_errors(spark, sf_dir):
    bad = landing.read_rejected(spark, _landed_orders(spark, sf_dir))
    return bad.select(jsonl.batch_of(F.col("file_name")).alias("batch_id"), "line", "error", "rejected_at")


@query
def failed_loads(spark, sf_dir):
    """Files that were not fully loaded in the last day, and from which line on."""
    history = landing.read_history(spark, _landed_orders(spark, sf_dir))
    rows = jsonl.failed_loads(history, timefn.minus(timefn.as_of_column(AS_OF), hours=24))
    return rows.select(jsonl.batch_of(F.col("file_name")).alias("batch_id"), "status", "first_error_line_number")


@query
def staged_history(spark, sf_dir):
    """The same counters for files that are staged only, from a parse of their lines."""
    history = jsonl.load_history(jsonl.text_lines(spark, _order_lines(spark, sf_dir)))
    return history.select(jsonl.batch_of(F.col("file_name")).alias("batch_id"), "status", "row_parsed", "row_count", "error_count", "first_error_line_number")


@query
def stage_partition_scan(spark, sf_dir):
    rows = stage_source.read_staged(spark, _stage_events(spark, sf_dir), "api_a", D.SPLIT_A[:10])
    return rows.select(V.field(F.col("payload"), "updated_at", "timestamp_ntz").alias("updated_at"), *stage_source.LAYOUT)


@query
def list_stage(spark, sf_dir):
    files = stage_source.list_stage(spark, _stage_events(spark, sf_dir)).where(F.col("file_name") != "")
    folder = F.regexp_extract("file_name", r"^(source=.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder")).agg((F.min("size") > 0).alias("has_content"))


@query
def incremental_extract(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "ts")
    return extract.changed_since(rows, "ts", "2024-01-20 12:00:00")


PAGE_SIZE, PAGES_PER_FETCH = 50, 20


def _event_pages(spark, sf_dir) -> DataFrame:
    """Pages of 50 events, 20 pages to a fetch. Each page is one bounded group."""
    page = F.floor(F.col("event_id") / PAGE_SIZE)
    record = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("type"))
    grouped = table(spark, sf_dir, "events").groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(record)).alias("records"))
    return grouped.select(
        F.floor(F.col("page") / PAGES_PER_FETCH).alias("fetch_id"), (F.col("page") % PAGES_PER_FETCH).alias("page_no"), "records"
    )


def _page_records(rows: DataFrame) -> DataFrame:
    return rows.select(
        "fetch_id", "page_no", F.col("item_no").cast("bigint").alias("item_no"),
        V.field(F.col("record"), "id", "bigint").alias("event_id"), V.field(F.col("record"), "type", "string").alias("event_type"),
    )


@query
def unnest_pages_cursor(spark, sf_dir):
    """Every third fetch ends early: page 12 has no next cursor."""
    stop = (F.col("fetch_id") % 3 == 0) & (F.col("page_no") == 12)
    cursor = F.when(~stop, F.concat(F.lit("c"), (F.col("page_no") + 1).cast("string")))
    payload = D.json_text(data=F.col("records"), meta=F.struct(cursor.alias("next_cursor")))
    rows = _event_pages(spark, sf_dir).select("fetch_id", "page_no", F.parse_json(payload).alias("payload"))
    return _page_records(pages.unnest_cursor(rows))


@query
def unnest_pages_offset(spark, sf_dir):
    """Totals: whole for most fetches, 430 for every third, none for every fifth."""
    total = F.when(F.col("fetch_id") % 5 == 4, F.lit(None)).when(F.col("fetch_id") % 3 == 0, 430).otherwise(PAGE_SIZE * PAGES_PER_FETCH)
    payload = D.json_text(items=F.col("records"), total=total.cast("bigint"), offset=F.col("page_no") * PAGE_SIZE, limit=F.lit(PAGE_SIZE))
    rows = _event_pages(spark, sf_dir).select("fetch_id", "page_no", F.parse_json(payload).alias("payload"))
    return _page_records(pages.unnest_offset(rows))


def _linked_pages(spark, sf_dir) -> DataFrame:
    """Pages without numbers. Of four fetches one is whole, one loops back from page 12 to page 5, one lacks page 7, and
    one has page 3 twice."""
    kind, no = F.col("fetch_id") % 4, F.col("page_no")
    named = lambda n: F.md5(F.concat_ws("-", F.col("fetch_id").cast("string"), n.cast("string")))
    after = F.when(no == PAGES_PER_FETCH - 1, F.lit(None)).when((kind == 1) & (no == 12), named(F.lit(5))).otherwise(named(no + 1))
    rows = _event_pages(spark, sf_dir).select(
        "fetch_id", "page_no", F.when(no > 0, named(no)).alias("cursor"),
        F.parse_json(D.json_text(data=F.col("records"), meta=F.struct(after.alias("next_cursor")))).alias("payload"),
    ).where(~((kind == 2) & (no == 7)))
    twice = rows.where((F.col("fetch_id") % 4 == 3) & (F.col("page_no") == 3))
    return rows.unionByName(twice).drop("page_no").repartition(7, "cursor")


@query
def unnest_pages_linked(spark, sf_dir):
    return _page_records(links.unnest_linked(_linked_pages(spark, sf_dir)))


@query
def linked_pages_report(spark, sf_dir):
    return links.link_report(_linked_pages(spark, sf_dir))


# Sinks


def _typed_events(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type", F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("user_id"))


@query
def write_jsonl_roundtrip(spark, sf_dir):
    """Write typed records with null fields and microseconds, read them back as they were."""
    path = workspace(spark, "jsonl")
    stage_sink.write_jsonl(_typed_events(spark, sf_dir), path, "b1", AS_OF)
    p = F.col("payload")
    return jsonl.read_jsonl(spark, path).select(
        V.field(p, "event_id", "bigint").alias("event_id"), V.field(p, "ts", "timestamp_ntz").alias("ts"),
        V.field(p, "user_id", "bigint").alias("user_id"), V.is_missing(p, "user_id").alias("user_id_missing"),
        *[V.field(p, k, "string").alias(k[1:]) for k in ("_batch_id", "_extracted_at", "_schema_version")],
    )


@query
def write_parquet_roundtrip(spark, sf_dir):
    path = workspace(spark, "parquet")
    stage_sink.write_parquet(_typed_events(spark, sf_dir), path, "b1", AS_OF)
    rows = spark.read.parquet(path)
    return rows.select("event_id", "ts", "user_id", *[F.col(k).alias(k[1:]) for k in ("_batch_id", "_extracted_at", "_schema_version")])


@query
def write_report(spark, sf_dir):
    path = workspace(spark, "report")
    report = stage_sink.write_parquet(_typed_events(spark, sf_dir), path, "b1", AS_OF)
    row = stage_sink.write_report(spark, report, "b1", AS_OF)
    return row.select("batch_id", "schema_version", "record_count", (F.col("file_size_bytes") > 0).alias("has_content"))


def _by_day(spark, raw: DataFrame) -> DataFrame:
    """RAW rows as a table in folders by ingest day, with that column."""
    path = workspace(spark, "raw")
    raw.withColumn(INGEST_DAY, F.to_date("ingested_at")).write.partitionBy(INGEST_DAY).parquet(path)
    return spark.read.schema(StructType([*raw.schema, StructField(INGEST_DAY, DateType())])).parquet(path)


@query
def retention_raw(spark, sf_dir):
    kept = governance.retained(_by_day(spark, D.raw_a(spark, sf_dir)), "raw", "2024-04-20 00:00:00")
    return kept.select("ordinal", "ingested_at", "batch_id")


def _raw_loads(spark, sf_dir) -> str:
    """RAW of source A as three loads have left it, each with rows of every day."""
    path = workspace(spark, "raw")
    rows = D.raw_a(spark, sf_dir).withColumns({
        "line": F.lit(None).cast("string"), "block_start": F.lit(0).cast("bigint"), "pos": F.col("ordinal").cast("bigint"),
        "load_id": (F.col("ordinal") % 3).cast("string"), "kind": F.lit("good"), INGEST_DAY: F.to_date("ingested_at"),
    })
    rows.drop("ordinal").write.partitionBy("load_id", "kind", INGEST_DAY).parquet(path)
    return path


@query
def compact_raw(spark, sf_dir):
    """Days before today packed into one load, today's left alone; a second call finds nothing to do."""
    path = _raw_loads(spark, sf_dir)
    for _ in range(2):
        raw_sink.compact_raw(spark, path, AS_OF)
    rows = spark.read.schema(StructType([*raw_sink.COLUMNS, *raw_sink.FOLDERS])).parquet(path)
    return rows.groupBy("load_id", INGEST_DAY).agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("pos").alias("places"))


@query
def purge_raw(spark, sf_dir):
    """What is left of packed RAW once the days past retention are dropped."""
    path = _raw_loads(spark, sf_dir)
    raw_sink.compact_raw(spark, path, AS_OF)
    raw_sink.purge_raw(spark, path, "2024-04-20 00:00:00")
    rows = landing.read_raw(spark, path, days=True)
    return rows.select(V.field(F.col("payload"), "id", "string").alias("id"), "ingested_at", INGEST_DAY)


@query
def expired_days(spark, sf_dir):
    return governance.expired_days(stage_source.staged_days(spark, _stage_events(spark, sf_dir)), "2024-02-14 00:00:00")


@query
def purge_expired(spark, sf_dir):
    """What is left of the staging area once its expired days are dropped; a second call finds none."""
    root = _stage_events(spark, sf_dir)
    for _ in range(2):
        tables.purge_expired(spark, root, "2024-02-14 00:00:00")
    left = stage_source.staged_lines(spark, root)
    return left.groupBy("source", "dt").agg(F.count(F.lit(1)).alias("line_count"))


# Clean


@query
def variant_extract_events(spark, sf_dir):
    """Typed fields of a JSON column, with a field that does not fit its type."""
    rows = table(spark, sf_dir, "events").select("event_id", F.parse_json("props").alias("p"), F.parse_json(D.json_a()).alias("q"))
    return rows.select(
        "event_id",
        V.field(F.col("p"), "k", "int").alias("k"),
        V.field(F.col("q"), "type", "int", "null").alias("type_as_number"),
        V.field(F.col("q"), ("metadata", "category"), "string").alias("category"),
        V.field(F.col("q"), "value", "decimal(38,0)").cast("double").alias("value"),
    )


@query
def clean_a_full(spark, sf_dir):
    return plain(D.clean_a(spark, sf_dir, with_nulls=True))


@query
def clean_b_full(spark, sf_dir):
    return plain(D.clean_b(spark, sf_dir, "o_custkey"))


@query
def cast_quarantine(spark, sf_dir):
    """Rows set aside because a field does not fit: every 29th event carries a word as its value."""
    word = F.when(F.col("event_id") % 29 == 0, F.lit("many"))
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.parse_json(D.json_text(id=D.event_id_text(), value=F.coalesce(word, F.col("event_id").cast("string")), updated_at=D.stamp("ts"))).alias("payload"),
    )
    _fits, aside = clean.split_castable(rows, API_A)
    return plain(aside.select("event_id", clean.CAST_ERRORS)).withColumnRenamed(clean.CAST_ERRORS, "cast_errors")


@query
def latest_per_key(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dd.latest_per_key(rows, "user_id", "ts", ["event_id"])


@query
def duplicate_keys(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id"))
    return analytics.duplicate_counts({"lineitem duplicates": lines, "orders duplicates": orders, "API_A duplicates": D.clean_a(spark, sf_dir)})


@query
def repeated_keys(spark, sf_dir):
    """The repeated keys themselves; NULL is one of them."""
    key = F.when(F.col("event_id") % 101 != 0, F.col("user_id"))
    return analytics.repeated_keys(table(spark, sf_dir, "events").select(key.alias("id")))


@query
def null_key_rows(spark, sf_dir):
    raw = D.raw_a(spark, sf_dir, with_nulls=True)
    rows = raw.select(V.field(F.col("payload"), "id", "string").alias("id"), "ordinal", "ingested_at", "batch_id")
    return analytics.null_key_rows(rows).drop("id")


def _old_and_new(spark, sf_dir, spec):
    if spec is API_A:
        raw, at = D.raw_a(spark, sf_dir, with_nulls=True), D.SPLIT_A
    else:
        raw, at = D.raw_b(spark, sf_dir, "o_custkey"), D.SPLIT_B
    old, new = D.split_raw(raw, "created_at", at)
    return clean.clean_full(old, spec, at, tie_break=["ordinal"]), clean.clean_full(new, spec, AS_OF, tie_break=["ordinal"])


@query
def merge_a(spark, sf_dir):
    return plain(merge.merge_newer(*_old_and_new(spark, sf_dir, API_A), "id", "updated_at"))


@query
def merge_b(spark, sf_dir):
    return plain(merge.merge_newer(*_old_and_new(spark, sf_dir, API_B), "id", "modified_at"))


@query
def merge_a_measured(spark, sf_dir):
    """The same upsert into a table of key buckets: the old rows as the first load, the new ones as the second."""
    return plain(buckets.read_buckets(spark, _two_loads(spark, sf_dir), API_A))


def _two_loads(spark, sf_dir, spec=API_A) -> str:
    path = workspace(spark, "buckets")
    for load_id, rows in enumerate(_old_and_new(spark, sf_dir, spec)):
        buckets.upsert_buckets(rows, path, spec, load_id, 16)
    return path


@query
def summary_by_buckets(spark, sf_dir):
    """The daily summary from bucket states that two upserts have kept."""
    days = [buckets.day_states(spark, _two_loads(spark, sf_dir, spec)) for spec in (API_A, API_B)]
    return analytics.summary_of_days(*days, AS_OF).withColumnRenamed("_refreshed_at", "refreshed_at")


@query
def checks_by_buckets(spark, sf_dir):
    """The quality checks from bucket states that two upserts have kept."""
    states = {spec: buckets.fact_states(spark, _two_loads(spark, sf_dir, spec)) for spec in (API_A, API_B)}
    return plain(quality.check_tables_by_states(states, AS_OF, "run-1").drop("check_id"))


@query
def incremental_slice(spark, sf_dir):
    raw = _by_day(spark, D.raw_a(spark, sf_dir))
    old, _new = D.split_raw(raw, "created_at", D.SPLIT_A)
    loaded = clean.clean_full(old, API_A, D.SPLIT_A, tie_break=["ordinal"])
    return plain(clean.incremental_slice(raw, loaded, API_A, AS_OF, tie_break=["ordinal"]))


@query
def stream_upsert(spark, sf_dir):
    """Two loads of RAW, upserted by a stream that runs after each, and once more over nothing."""
    old, new = D.split_raw(D.raw_a(spark, sf_dir, with_nulls=True), "created_at", D.SPLIT_A)
    raw, out, seen = workspace(spark, "raw"), workspace(spark, "clean"), workspace(spark, "offsets")
    order = ["ingested_at"]
    for load_id, rows in enumerate((old, new)):
        rows.select(*D.RAW_COLUMNS[:-1]).write.parquet(f"{raw}/load_id={load_id}")
        upsert_stream.stream_upsert(spark, raw, out, seen, API_A, AS_OF, order).awaitTermination()
    upsert_stream.stream_upsert(spark, raw, out, seen, API_A, AS_OF, order).awaitTermination()
    return plain(buckets.read_buckets(spark, out, API_A))


# Record transforms


@query
def validate_required(spark, sf_dir):
    rows = validate.with_validation_errors(D.messy_records(spark, sf_dir), ["id", "createdAt", "region"], "payload")
    return rows.select("ordinal", F.array_join(validate.ERRORS, "; ").alias("errors"))


@query
def quarantine(spark, sf_dir):
    """Rejected records of source A as written to and read from the quarantine table."""
    _valid, rejected = transform.transform_source(D.messy_records(spark, sf_dir), "api_a")
    path = workspace(spark, "quarantine")
    tables.append_rows(rejected, path)
    rows = spark.read.parquet(path)
    return rows.select(
        F.col(validate.INDEX).alias("record_index"), F.array_join(validate.ERRORS, "; ").alias("errors"),
        V.field(F.col("payload"), "event_type", "string").alias("event_type"),
    )


def _nested(spark, sf_dir) -> DataFrame:
    n, kind = F.col("event_id"), F.col("event_type")
    rack = F.struct(kind.alias("aisle"), F.concat(F.lit("c"), (n % 7).cast("string")).alias("level"))
    device = F.struct(F.col("user_id").cast("string").alias("model"), F.struct((n % 90).alias("height"), rack.alias("rack")).alias("mount"))
    parts = F.array(F.struct(F.lit("x9").alias("code"), (n % 5).alias("left")), F.struct(F.lit("w").alias("code"), F.lit(0).alias("left")))
    return spread(table(spark, sf_dir, "events")).select(F.col("event_id").alias("id"), device.alias("device"), parts.alias("parts"))


def _nested_payload(spark, sf_dir) -> DataFrame:
    text = F.concat(F.rtrim(D.json_text(id=F.col("id"), device=F.col("device"), parts=F.col("parts")), F.lit("}")), F.lit(', "empty": {}}'))
    # The trailing brackets of the list keep the braces above apart from the record's own.
    return _nested(spark, sf_dir).select("id", F.parse_json(text).alias("payload"))


@query
def flatten_nested(spark, sf_dir):
    rows = flatten.flatten_records(_nested_payload(spark, sf_dir))
    return rows.select("id", text_of(F.col("payload")).alias("flat"))


@query
def flatten_two_levels(spark, sf_dir):
    """Depth 1: what lies deeper stays nested."""
    rows = flatten.flatten_records(_nested_payload(spark, sf_dir), sep=".", max_depth=1)
    return rows.select("id", text_of(F.col("payload")).alias("flat"))


@query
def flatten_typed(spark, sf_dir):
    """The schema is found in one pass, then flattening is a projection."""
    payload = _nested_payload(spark, sf_dir).select("payload")
    flat = flatten.flatten_struct(flatten.type_payload(payload, "payload"))
    return flat.select("id", "device_model", "device_mount_height", "device_mount_rack_aisle", "device_mount_rack_level", F.size("parts").cast("bigint").alias("n_parts"))


def _odd_keys(spark, sf_dir) -> DataFrame:
    text = F.concat(
        F.lit('{"userId": '), F.col("user_id").cast("string"), F.lit(', "event-type": "'), F.col("event_type"),
        F.lit('", "Total  Amount@": '), F.col("event_id").cast("string"), F.lit(', "someAPIKey": "x", "__hidden__": null}'),
    )
    return spread(table(spark, sf_dir, "events")).select("event_id", F.parse_json(text).alias("payload"))


@query
def normalize_keys(spark, sf_dir):
    rows = _odd_keys(spark, sf_dir)
    return rows.select(
        "event_id",
        text_of(normalize.normalize_variant("payload")).alias("record"),
        text_of(normalize.normalize_variant("payload", split_acronyms=True)).alias("record_split"),
    )


@query
def normalize_source_order(spark, sf_dir):
    """Fields that get one name, in two orders, at the top and inside: the last in the text stays."""
    a, b = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    pair = lambda x, y, m, n: F.concat(F.lit(f'"{x}": '), m, F.lit(f', "{y}": '), n)
    turned = F.col("event_id") % 2 == 1
    top = F.when(turned, pair("userId", "user_id", b, a)).otherwise(pair("user_id", "userId", a, b))
    inner = F.when(turned, pair("Tag-No", "tagNo", a, b)).otherwise(pair("tagNo", "Tag-No", b, a))
    text = F.concat(F.lit("{"), top, F.lit(', "Meta": {'), inner, F.lit("}}"))
    rows = spread(table(spark, sf_dir, "events")).select(F.col("event_id").alias("ordinal"), text.alias("text"), F.parse_json(text).alias("payload"))
    valid, _ = transform.transform(rows, transform.TransformSpec(text="text"))
    p = F.col("payload")
    return valid.select("ordinal", V.field(p, "user_id", "bigint").alias("user_id"), V.field(p, ("meta", "tag_no"), "bigint").alias("tag_no"))


@query
def key_report(spark, sf_dir):
    """Keys that meet under one name: every event has userId, every fourth also user_id."""
    n = F.col("event_id")
    extra = F.when(n % 4 == 0, F.lit(', "user_id": 1')).otherwise(F.lit(""))
    text = F.concat(F.lit('{"userId": 1, "other": 2, "!!": 3'), extra, F.lit("}"))
    return normalize.key_report(table(spark, sf_dir, "events").select(F.parse_json(text).alias("payload")))


@query
def trim_strings(spark, sf_dir):
    """Whole documents, padded with several kinds of blank."""
    padded = F.concat(F.lit(" \u00a0\t"), F.col("text"), F.lit("\u3000\r\n "))
    done = trim_ws(padded)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(done).alias("digest"), F.length(done).cast("bigint").alias("n_chars"))


def _spellings():
    """Event times in twelve spellings, by event id."""
    ts, n = F.col("ts"), F.col("event_id") % 12
    spelled = [
        D.stamp(ts),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'+0530'"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'-07:00'"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(ts, "yyyy-M-d"),
        F.date_format(ts, "dd/MM/yyyy HH:mm:ss"),
        F.date_format(ts, "MM/dd/yyyy HH:mm:ss"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.date_format(ts, "dd.MM.yyyy HH:mm"),
        F.lit("not a timestamp"),
    ]
    out = F.when(n == 0, spelled[0])
    for i, text in enumerate(spelled[1:], 1):
        out = out.when(n == i, text)
    return out


@query
def normalize_ts(spark, sf_dir):
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    epoch = F.when(F.col("event_id") % 2 == 0, F.floor(micros / 1000)).otherwise(F.floor(micros / 1000000))
    rows = spread(table(spark, sf_dir, "events")).select("event_id", _spellings().alias("text"), epoch.alias("epoch"))
    return rows.select(
        "event_id",
        timefn.normalize_ts("text").alias("normal"),
        timefn.normalize_ts("text", to_utc=True).alias("normal_utc"),
        timefn.normalize_ts("epoch", "bigint").alias("from_epoch"),
    )


@query
def normalize_records(spark, sf_dir):
    """Nested and listed objects; the timestamp field is met at any depth."""
    rows = D.messy_records(spark, sf_dir)
    done = normalize.normalize_variant("payload", ["created_at", "updated_at"])
    return rows.select("ordinal", text_of(done).alias("record"))


@query
def normalize_typed(spark, sf_dir):
    """The same on typed columns, as a projection."""
    inner = F.struct(F.concat(F.lit(" "), F.col("event_type")).alias("Type-Name"), F.col("ts").alias("updatedAt"))
    rows = spread(table(spark, sf_dir, "events")).select(F.col("event_id").alias("eventId"), F.array(inner).alias("subRecords"), _spellings().alias("createdAt"))
    done = normalize.normalize_struct(rows, ["created_at", "updated_at"])
    one = F.element_at("sub_records", 1)
    return done.select("event_id", "created_at", one["type_name"].alias("type_name"), one["updated_at"].alias("updated_at"))


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")


@query
def dedupe_first(spark, sf_dir):
    return dd.dedupe(_orders(spark, sf_dir), ["o_custkey"], "o_orderdate", "first", tie_break=["o_orderkey"])


@query
def dedupe_last(spark, sf_dir):
    return dd.dedupe(_orders(spark, sf_dir), ["o_custkey"], "o_orderdate", "last", tie_break=["o_orderkey"])


@query
def dedupe_unsorted(spark, sf_dir):
    """Without a sort column the first row in input order stays; NULL keys are dropped."""
    key = F.when(F.col("event_id") % 101 != 0, F.col("user_id"))
    rows = table(spark, sf_dir, "events").select("event_id", key.alias("user_id"))
    return dd.dedupe(rows, ["user_id"], tie_break=["event_id"])


@query
def dedupe_composite(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")
    return dd.dedupe(rows, ["l_orderkey", "l_linenumber"], "l_shipdate", "last", tie_break=["l_partkey", "l_suppkey", "l_quantity"])


def _record_view(valid: DataFrame, *names: str) -> DataFrame:
    return valid.select("ordinal", *[V.field(F.col("payload"), n, "string").alias(n) for n in names])


@query
def transform_a(spark, sf_dir):
    valid, _rejected = transform.transform_source(D.messy_records(spark, sf_dir), "api_a")
    return _record_view(valid, "id", "created_at", "updated_at", "user_name", "event_type", "meta_data")


@query
def transform_b(spark, sf_dir):
    valid, _rejected = transform.transform_source(D.messy_b_records(spark, sf_dir), "api_b")
    return _record_view(valid, "id", "created_at", "modified_at", "order_state", "amount")


@query
def transform_records(spark, sf_dir):
    """Flatten, normalise, validate and dedupe; valid and rejected rows counted per event type."""
    work = workspace(spark, "normalized")
    valid, rejected = transform.transform_source(D.messy_records(spark, sf_dir), "api_a", flatten=True, work=work)
    names = ["event_type", "meta_data_category_name"]

    def counted(df: DataFrame, outcome: str) -> DataFrame:
        fields = [V.field(F.col("payload"), n, "string").alias(n) for n in names]
        return df.select(*fields).groupBy(*names).agg(F.count(F.lit(1)).alias("records")).withColumn("outcome", F.lit(outcome))

    return counted(valid, "valid").unionByName(counted(rejected, "rejected"))


# Analytics


def _both(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    return D.clean_a(spark, sf_dir), D.clean_b(spark, sf_dir)


@query
def daily_event_counts(spark, sf_dir):
    return analytics.daily_event_counts(*_both(spark, sf_dir))


@query
def daily_summary(spark, sf_dir):
    """The summary as a table: written as a new version, read back."""
    path = workspace(spark, "summary")
    tables.replace_table(analytics.daily_summary(*_both(spark, sf_dir), AS_OF, ids_unique=True), path)
    rows = tables.read_table(spark, path, runs.SUMMARY_SCHEMA)
    return rows.withColumnRenamed("_refreshed_at", "refreshed_at")


@query
def data_freshness(spark, sf_dir):
    return analytics.data_freshness(*_both(spark, sf_dir), AS_OF)


@query
def ingestion_history(spark, sf_dir):
    """Over clean tables, whose ids are unique."""
    return analytics.ingestion_history(*_both(spark, sf_dir), ids_unique=True)


@query
def ingestion_history_exact(spark, sf_dir):
    """Over rows that repeat ids, which are counted distinct."""
    a = clean.project(D.raw_a(spark, sf_dir), API_A, AS_OF)
    b = clean.project(D.raw_b(spark, sf_dir, "o_custkey"), API_B, AS_OF)
    return analytics.ingestion_history(a, b)


@query
def top_categories(spark, sf_dir):
    return plain(analytics.top_categories(D.clean_a(spark, sf_dir)))


@query
def top_k_categories(spark, sf_dir):
    return plain(analytics.top_k_categories(D.clean_a(spark, sf_dir), 10))


@query
def status_distribution(spark, sf_dir):
    return plain(analytics.status_distribution(D.clean_a(spark, sf_dir)))


@query
def priority_distribution(spark, sf_dir):
    return plain(analytics.priority_distribution(D.clean_b(spark, sf_dir)))


@query
def hourly_activity(spark, sf_dir):
    return analytics.hourly_activity(*_both(spark, sf_dir))


@query
def executive_dashboard(spark, sf_dir):
    return analytics.executive_dashboard(*_both(spark, sf_dir), AS_OF)


@query
def executive_dashboard_joined(spark, sf_dir):
    """The dashboard as a left join of the freshness view and the daily counts."""
    a, b = _both(spark, sf_dir)
    return analytics.dashboard_of(analytics.data_freshness(a, b, AS_OF), analytics.daily_event_counts(a, b, ordered=False), AS_OF)


@query
def clean_stats(spark, sf_dir):
    return analytics.clean_stats(*_both(spark, sf_dir))


@query
def table_counts(spark, sf_dir):
    a, b = _both(spark, sf_dir)
    named = {"API_A_EVENTS": D.raw_a(spark, sf_dir), "API_B_EVENTS": D.raw_b(spark, sf_dir), API_A.table: a, API_B.table: b}
    return analytics.table_counts(named)


@query
def recent_updates(spark, sf_dir):
    return plain(analytics.recent_updates(D.clean_a(spark, sf_dir), as_of=AS_OF)).select("id", "updated_at", "status", "value")


@query
def volume_trend_7d(spark, sf_dir):
    return analytics.volume_trend(analytics.daily_event_counts(*_both(spark, sf_dir), ordered=False), AS_OF)


@query
def schema_drift(spark, sf_dir):
    raw = D.raw_a(spark, sf_dir, new_field=F.col("event_id"), ID=F.lit(1))
    return governance.schema_drift(_by_day(spark, raw), D.clean_a(spark, sf_dir), AS_OF)


@query
def masked_view(spark, sf_dir):
    address = F.concat("c_name", F.lit("@example.com"))
    people = table(spark, sf_dir, "customer").select("c_custkey", address.alias("email"), address.alias("full_email"))
    return governance.masked(governance.masked(people, ["email"], "ANALYST_ROLE"), ["full_email"], "TRANSFORMER_ROLE")


@query
def masked_view_sql(spark, sf_dir):
    """A view over stored customers, read in SQL by two roles and by a session without one."""
    path = workspace(spark, "people")
    address = F.concat("c_name", F.lit("@example.com")).alias("email")
    table(spark, sf_dir, "customer").select("c_custkey", address, "c_name").write.parquet(path)
    roles.register_masking(spark)
    roles.masked_view(spark, "people", path, ["c_custkey", "email", "c_name"], ["email"])
    seen = None
    for role in ("ANALYST_ROLE", "TRANSFORMER_ROLE", None):
        roles.set_role(spark, role)
        rows = spark.sql("SELECT session.reader_role AS role, c_custkey, email, c_name FROM people")
        out = workspace(spark, "seen")
        rows.write.parquet(out)
        part = spark.read.schema(rows.schema).parquet(out)
        seen = part if seen is None else seen.unionByName(part)
    return seen


def _sketched(spark, sf_dir) -> DataFrame:
    """Sketches of raw events and orders per day and batch, as a stored table."""
    path = workspace(spark, "sketches")
    a = clean.project(D.raw_a(spark, sf_dir), API_A, AS_OF)
    b = clean.project(D.raw_b(spark, sf_dir, "o_custkey"), API_B, AS_OF)
    for source, rows in (("api_a", a), ("api_b", b)):
        tables.append_rows(sketches.day_sketches(rows, source), path)
    return spark.read.schema(sketches.SCHEMA).parquet(path)


@query
def day_id_counts(spark, sf_dir):
    return _sketched(spark, sf_dir).drop("ids")


@query
def weekly_distinct_ids(spark, sf_dir):
    """Rows per source and week, and whether the estimate of distinct ids is within three standard errors of the count."""
    weeks = sketches.weekly_ids(_sketched(spark, sf_dir))
    parts = []
    for source, rows in (("api_a", clean.project(D.raw_a(spark, sf_dir), API_A, AS_OF)), ("api_b", clean.project(D.raw_b(spark, sf_dir, "o_custkey"), API_B, AS_OF))):
        week = F.to_date(F.date_trunc("week", "created_at")).alias("week")
        parts.append(rows.groupBy(week).agg(F.count_distinct("id").alias("unique_ids")).withColumn("source", F.lit(source)))
    both = weeks.join(parts[0].unionByName(parts[1]), ["source", "week"])
    near = F.abs(F.col("unique_ids_estimate") - F.col("unique_ids")) <= F.greatest(F.lit(1), 0.025 * F.col("unique_ids"))
    return both.select("source", "week", "row_count", "unique_ids", near.alias("estimate_is_near"))


@query
def raw_sample(spark, sf_dir):
    """Five RAW rows, the first in input order."""
    raw = D.raw_a(spark, sf_dir).orderBy("ordinal").limit(5)
    return raw.select("ordinal", "source", "ingested_at", "batch_id", V.field(F.col("payload"), "id", "string").alias("id"))


# Data quality


def _checked(spark, sf_dir, as_of: str = AS_OF, until: bool = False) -> DataFrame:
    """Checks of a table with a NULL id, and of one with repeated and no fresh rows."""
    a = D.clean_a(spark, sf_dir, with_nulls=True)
    b = clean.project(D.raw_b(spark, sf_dir, "o_custkey"), API_B, AS_OF)
    if until:
        moment = timefn.as_of_column(as_of)
        a, b = (df.where(F.col("ingested_at") <= moment) for df in (a, b))
    return quality.check_tables({API_A: a, API_B: b}, as_of, "run-1")


@query
def dq_results(spark, sf_dir):
    """Results as appended to and read from the result table."""
    path = workspace(spark, "checks")
    tables.append_rows(_checked(spark, sf_dir), path)
    return plain(spark.read.parquet(path).drop("check_id"))


@query
def dq_latest(spark, sf_dir):
    return plain(quality.latest_results(_checked(spark, sf_dir), AS_OF))


@query
def dq_summary(spark, sf_dir):
    return plain(quality.summary(_checked(spark, sf_dir), AS_OF))


@query
def dq_alerts(spark, sf_dir):
    return plain(quality.alerts(_checked(spark, sf_dir), AS_OF, minutes=5))


@query
def dq_daily(spark, sf_dir):
    """Three runs over the data known at their time; the oldest is outside the week."""
    history = None
    for moment in (AS_OF, "2024-01-30 04:00:00", "2024-01-22 04:00:00"):
        part = _checked(spark, sf_dir, moment, until=True)
        history = part if history is None else history.unionByName(part)
    return quality.per_day(history, AS_OF)


@query
def dq_gate(spark, sf_dir):
    return plain(quality.critical_failures(_checked(spark, sf_dir)).select("check_name", "table_name", "result_value", "error_message"))


# Run metrics


def _day():
    return F.date_format("ts", "yyyyMMdd").alias("batch_id")


def _source():
    return F.when(F.col("user_id") % 2 == 0, "api_a").otherwise("api_b").alias("source")


@query
def request_metrics(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        _source(), _day(), F.col("value").alias("duration_ms"), (F.col("event_id") % 3).alias("retry_count"), (F.col("event_type") != "error").alias("success")
    )
    return metrics.request_metrics(log)


@query
def step_log_rollup(spark, sf_dir):
    """Log lines as JSON text, some of them free text."""
    n, kind = F.col("event_id"), F.col("event_type")
    steps = F.array(*[F.lit(s) for s in ("ingestion", "api_fetch", "transform", "s3_upload")])
    status = F.when(kind == "error", "error").when(kind == "signup", "started").otherwise("success")
    record = F.to_json(F.struct(
        _source(), _day(), F.element_at(steps, (n % 4 + 1).cast("int")).alias("step"), (n % 500).alias("row_count"),
        F.col("value").alias("request_duration_ms"), (n % 3).alias("retry_count"), status.alias("status"),
        F.when(kind == "error", F.concat(F.lit("failure "), n.cast("string"))).alias("error"), D.stamp("ts").alias("timestamp"),
    ))
    lines = table(spark, sf_dir, "events").select(F.when(n % 40 == 0, F.lit("plain text")).otherwise(record).alias("value"))
    return metrics.step_log_rollup(metrics.parse_step_logs(lines))


def _source_results(spark, sf_dir) -> DataFrame:
    """One result row per day and source."""
    return table(spark, sf_dir, "events").groupBy(_day(), _source()).agg(
        F.count(F.lit(1)).alias("records_fetched"),
        F.count_if(F.col("event_type") != "error").alias("records_staged"),
        F.when(F.bool_or(F.col("event_id") % 997 == 0), "error").otherwise("success").alias("status"),
    )


@query
def run_summary(spark, sf_dir):
    return metrics.run_summary(_source_results(spark, sf_dir))


@query
def run_metrics(spark, sf_dir):
    """Runs with their check counts, from all events."""
    passed = F.when(F.col("event_id") % 5 == 0, F.lit(None)).otherwise(F.col("event_type") != "error")
    checks = table(spark, sf_dir, "events").select(_day(), passed.alias("passed"))
    return metrics.run_metrics(metrics.run_summary(_source_results(spark, sf_dir)), checks)


@query
def hourly_run(spark, sf_dir):
    """Both sources from records to dashboard: ingest, land, upsert, summarise, check."""
    layout = runs.Layout(workspace(spark, "installation"))
    inputs = {"api_a": lambda: D.messy_records(spark, sf_dir), "api_b": lambda: D.messy_b_records(spark, sf_dir)}
    outcome = runs.run_ingestion(spark, inputs, layout, batch_id="run1", at=AS_OF)
    runs.run_hourly(spark, layout, outcome, "run1", AS_OF)
    return runs.dashboard(spark, layout, AS_OF)


@query
def hourly_rerun(spark, sf_dir):
    """Two batches under one time, the second run twice: every id once, checks and metrics once per batch."""
    layout = runs.Layout(workspace(spark, "installation"))
    for batch, part in (("r1", 0), ("r2", 1), ("r2", 1)):
        inputs = {
            "api_a": lambda part=part: D.messy_records(spark, sf_dir).where(F.col("ordinal") % 2 == part),
            "api_b": lambda part=part: D.messy_b_records(spark, sf_dir).where(F.col("ordinal") % 2 == part),
        }
        outcome = runs.run_ingestion(spark, inputs, layout, batch_id=batch, at=AS_OF)
        runs.run_hourly(spark, layout, outcome, batch, AS_OF)
    counts = []
    for source, spec in SOURCES.items():
        t = buckets.read_buckets(spark, layout.clean(source), spec)
        counts.append(t.agg(F.lit(source).alias("part"), F.count(F.lit(1)).alias("row_count"), F.count_distinct(spec.key).alias("ids")))
    for name, path in (("checks", layout.checks), ("metrics", layout.metrics)):
        rows = spark.read.parquet(path).groupBy("batch_id")
        counts.append(rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.concat(F.lit(f"{name} "), F.col("batch_id")).alias("part"), "row_count", "row_count"))
    out = counts[0].union(counts[1]).union(counts[2]).union(counts[3])
    return out.toDF("part", "row_count", "ids")
