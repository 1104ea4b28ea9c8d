"""What the physical plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from harness.registry import QUERIES
from millrace.operators import clean
from millrace.operators.dedupe import latest_per_key
from millrace.operators.merge import merge_newer, merge_newer_small
from millrace.plans import analytics, quality
from millrace.specs import API_A, API_B, RAW_SCHEMA

SMALL = "/root/testdata/sf0.001"

# Queries that run jobs of their own before they return.
JOBS = {"hourly_run", "land_raw_a", "land_raw_b", "land_refresh", "stream_upsert", "daily_summary", "dq_results", "merge_a_measured", "hourly_rerun", "summary_by_buckets", "checks_by_buckets", "transform_records", "load_history", "load_errors", "failed_loads", "retention_raw", "incremental_slice", "schema_drift", "compact_raw", "purge_raw", "unnest_pages_linked", "linked_pages_report", "masked_view_sql", "day_id_counts", "weekly_distinct_ids"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """RAW and clean tables on disk, as a cluster would have them."""
    from harness import adapters as D

    root = str(tmp_path_factory.mktemp("stored"))
    D.raw_a(spark, SMALL).write.parquet(f"{root}/raw")
    D.clean_a(spark, SMALL).write.parquet(f"{root}/a")
    D.clean_b(spark, SMALL).write.parquet(f"{root}/b")
    read = spark.read
    return (
        read.schema(RAW_SCHEMA).parquet(f"{root}/raw"),
        spark.read.schema(API_A.clean_schema).parquet(f"{root}/a"),
        spark.read.schema(API_B.clean_schema).parquet(f"{root}/b"),
    )


def test_a_hot_key_sends_one_row_per_task(spark):
    """A third of the rows share a key, yet each task ships one row of it."""
    rows = spark.range(0, 30000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    best = latest_per_key(rows, "k", "v")
    plan = plan_of(best)
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange") < plan.index("row_number(), 1, Partial")
    assert best.where("k = -1").first().v == 29997 and best.count() == 20001


def test_raw_reads_only_the_fields_it_needs(stored):
    raw, _, _ = stored
    plan = plan_of(clean.project(raw, API_A).select("id", "category", "value"))
    schema = plan.split("ReadSchema: ")[1]
    assert schema.startswith("struct<payload:struct<0:string,1:") and "ingested_at" not in schema.split("\n")[0]


def test_incremental_slice_prunes_at_the_scan(stored):
    raw, a, _ = stored
    plan = plan_of(clean.incremental_slice(raw, a, API_A))
    assert "ingested_at" in plan.split("DataFilters")[1] and "Subquery" in plan


def test_time_bounds_reach_the_day_folders(spark, tmp_path):
    """Known bounds and those of a scalar subquery alike; files of older days are not opened."""
    from harness import adapters as D
    from harness.registry import _by_day
    from millrace.operators import governance

    raw = _by_day(spark, D.raw_a(spark, SMALL))
    whole = len(raw.inputFiles())
    loaded = clean.clean_full(raw.where(F.col("ingested_at") < "2024-01-25"), API_A, "2024-01-25 00:00:00")
    made = {
        "slice": clean.incremental_slice(raw, loaded, API_A),
        "kept": governance.retained(raw, "raw", "2024-04-20 00:00:00"),
        "drift": governance.schema_drift(raw, loaded, "2024-01-31"),
    }
    for name, df in made.items():
        plan = plan_of(df)
        filters = [x.split("PushedFilters")[0] for x in plan.split("PartitionFilters: ")[1:]]
        assert any("ingest_day" in f for f in filters), name
        assert name != "slice" or any("ingest_day" in f and "Subquery" in f for f in filters)
    made["slice"].collect()
    scan = made["kept"]._jdf.queryExecution().executedPlan().toString()
    assert made["kept"].count() < raw.count() and "ingest_day" in scan and whole > 25


def test_views_read_few_columns(stored):
    _, a, b = stored
    plan = plan_of(analytics.status_distribution(a))
    assert "ReadSchema: struct<status:string>" in plan
    plan = plan_of(analytics.daily_event_counts(a, b, ids_unique=True))
    assert plan.count("ReadSchema: struct<id:string,created_at:timestamp_ntz>") == 2
    # One shuffle of day totals per source, and the final sort.
    assert plan.count("Exchange hashpartitioning") == 2


def test_shares_take_their_total_from_the_groups(stored):
    _, a, _ = stored
    df = analytics.status_distribution(a)
    rows = df.collect()
    assert "ReusedExchange" in plan_of(df) or "ReusedSubquery" in plan_of(df) or "ReusedQueryStage" in plan_of(df)
    assert abs(sum(r.percentage for r in rows) - 100) < 1


def test_dashboard_is_one_scan_per_table_without_shuffled_rows(stored):
    _, a, b = stored
    plan = plan_of(analytics.executive_dashboard(a, b, "2024-01-31"))
    assert plan.count("FileScan") == 2 and "hashpartitioning" not in plan and "Join" not in plan


def test_checks_are_one_scan_per_table(stored):
    _, a, b = stored
    plan = plan_of(quality.check_tables({API_A: a, API_B: b}, "2024-01-31"))
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 2
    assert "SortAggregate" not in plan


def test_small_merge_does_not_shuffle_the_target(stored):
    _, a, _ = stored
    slice_df = a.limit(5)
    assert "hashpartitioning" not in plan_of(merge_newer_small(a, slice_df, "id", "updated_at"))
    assert "FullOuter" in plan_of(merge_newer(a, a, "id", "updated_at"))


def test_an_ingest_reads_its_source_once(spark, payloads, tmp_path):
    """Whatever the outputs need, every record is taken from the source one time."""
    from millrace.plans import runs

    taken = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            taken.add(batch.num_rows)
            yield batch

    rows = payloads(*[{"id": str(i % 7), "updatedAt": "2024-01-01", "Deep": {"A b": " x "}} for i in range(60)], {"id": None})
    plain = rows.select("ordinal", F.to_json("payload").alias("text")).mapInArrow(count, "ordinal bigint, text string")
    records = plain.select("ordinal", F.parse_json("text").alias("payload"))
    layout = runs.Layout(str(tmp_path))
    report = runs.ingest_source(records, "api_a", layout, "b1", "2024-01-02 00:00:00")
    assert taken.value == 61
    assert (report["records_fetched"], report["record_count"], report["records_rejected"]) == (61, 7, 1)


def test_step_logs_are_counted_by_hash(spark):
    plan = plan_of(QUERIES["step_log_rollup"](spark, SMALL))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_expired_days_come_from_the_listing(spark):
    plan = plan_of(QUERIES["expired_days"](spark, SMALL))
    assert "FileScan text" not in plan and "FileScan binaryFile" in plan


def test_text_minimum_never_sorts_rows(stored):
    _, a, b = stored
    plan = plan_of(analytics.ingestion_history(a, b))
    for part in plan.split("SortAggregate")[1:]:
        assert "functions=[" not in part[:400] or "min(file_name" in part[:400]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_no_query_pairs_everything_or_gathers_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for above, line in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in above, "only totals may meet in one task"
