"""Whole runs: ingest records into the stage, and stage to analytics with checks and gate."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from millrace.operators.clean import STABLE_ORDER
from millrace.plans import analytics, quality
from millrace.plans.metrics import run_metrics, run_summary
from millrace.plans.transform import transform_source
from millrace.session import whole_payloads, workspace
from millrace.sinks.stage import stage
from millrace.sinks.buckets import day_states, fact_states, read_buckets
from millrace.sinks.raw import compact_raw, load_ids, purge_raw
from millrace.sinks.tables import drop_folder, read_table, replace_batches, replace_table
from millrace.sources.extract import changed_since
from millrace.specs import SOURCES
from millrace.streaming.landing import land
from millrace.streaming.upsert import stream_upsert

RESULT_SCHEMA = (
    "source string, batch_id string, status string, records_fetched bigint, records_staged bigint, "
    "records_rejected bigint, error string, duration_seconds double"
)

SUMMARY_SCHEMA = "source string, event_date date, event_count bigint, unique_records bigint, _refreshed_at timestamp_ntz"


# Hourly loads of a day that are packed into one.
PACK_LOADS = 12


@dataclass(frozen=True)
class Layout:
    """Where the layers of one installation live, below a shared root."""

    root: str

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def checks(self) -> str:
        return f"{self.root}/analytics/dq_check_results"

    @property
    def summary(self) -> str:
        return f"{self.root}/analytics/anl_daily_summary"

    @property
    def metrics(self) -> str:
        return f"{self.root}/analytics/run_metrics"

    def raw(self, source: str) -> str:
        return f"{self.root}/raw/{source}"

    def clean(self, source: str) -> str:
        return f"{self.root}/clean/{SOURCES[source].table.lower()}"

    def quarantine(self, source: str) -> str:
        return f"{self.root}/quarantine/{source}"

    def checkpoint(self, source: str) -> str:
        return f"{self.root}/checkpoints/land_{source}"

    def clean_checkpoint(self, source: str) -> str:
        return f"{self.root}/checkpoints/clean_{source}"


def new_run_id() -> str:
    return uuid.uuid4().hex[:12]


def _counted(df: DataFrame, *more: Column) -> tuple[DataFrame, Observation]:
    """The rows, and their number (and other aggregates) once they have been written: no pass of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n"), *more), seen


def ingest_source(records: DataFrame, source: str, layout: Layout, batch_id: str, at=None, ordinal: str = "ordinal") -> dict:
    """Transform a source's ``(ordinal, payload)`` records, stage the valid and set the others aside.

    The source is read once: its records are put in a work folder, their schema being noted in passing, and so are the
    normalised ones, from which both outputs are taken. Outputs replace those of an earlier attempt at the same batch.
    """
    spark, work = records.sparkSession, workspace(records.sparkSession, f"ingest-{source}")
    try:
        counted, fetched = _counted(records, F.schema_of_variant_agg("payload").alias("schema"))
        with whole_payloads(spark):
            counted.write.parquet(f"{work}/records")
        kept = spark.read.schema(records.schema).parquet(f"{work}/records")
        valid, rejected = transform_source(kept, source, ordinal, work=f"{work}/normalized", schema=fetched.get["schema"])
        report = stage(valid.select("payload"), layout.staging, source, batch_id, at, payload="payload")
        rejected, set_aside = _counted(rejected.withColumn("_batch_id", F.lit(batch_id)))
        out = rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch_id")
        out.parquet(layout.quarantine(source))
    finally:
        drop_folder(spark, work)
    return {**report, "records_fetched": fetched.get["n"], "records_rejected": set_aside.get["n"]}


def run_ingestion(
    spark: SparkSession,
    inputs: Mapping[str, Callable[[], DataFrame]],
    layout: Layout,
    since=None,
    since_column: str | None = None,
    batch_id: str | None = None,
    at: dt.datetime | str | None = None,
) -> DataFrame:
    """Ingest every source; a failing one is reported as an error and does not stop the others."""
    batch_id = batch_id or new_run_id()
    rows = []
    for source, read in inputs.items():
        begin = time.monotonic()
        try:
            records = read()
            if since_column:
                records = changed_since(records, since_column, since)
            report = ingest_source(records, source, layout, batch_id, at)
            outcome = ("success", report["records_fetched"], report["record_count"], report["records_rejected"], None)
        except Exception as error:  # noqa: BLE001 - the sources are independent of each other
            outcome = ("error", None, None, None, str(error))
        rows.append((source, batch_id, *outcome, time.monotonic() - begin))
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def run_hourly(
    spark: SparkSession, layout: Layout, ingested: DataFrame, batch_id: str, as_of=None, tie_break=STABLE_ORDER, enforce: bool = True
) -> DataFrame:
    """Land, clean, refresh the summary, check, gate; returns the run's metrics.

    Landing waits for its query, so the clean step sees all that was staged. Which RAW rows are new is
    the checkpoint's knowledge and not the clock's, so a run that is repeated, under the same time or
    another, loses no row and counts none twice; its checks and metrics replace those of the first
    attempt. The metrics are written before the gate may raise.
    """
    for source, spec in SOURCES.items():
        query = land(spark, layout.staging, source, layout.raw(source), layout.checkpoint(source), as_of)
        query.awaitTermination()
        loads = load_ids(spark, layout.raw(source))
        merge = stream_upsert(spark, layout.raw(source), layout.clean(source), layout.clean_checkpoint(source), spec, as_of, tie_break)
        merge.awaitTermination()
        # The upsert has taken these loads, so their finished days may be packed and old ones dropped.
        compact_raw(spark, layout.raw(source), as_of, PACK_LOADS, loads)
        purge_raw(spark, layout.raw(source), as_of)
    # Summary and checks come from the states of the buckets, of which the upsert renewed those it touched.
    days = [day_states(spark, layout.clean(source)) for source in SOURCES]
    replace_table(analytics.summary_of_days(*days, as_of), layout.summary)
    facts = {spec: fact_states(spark, layout.clean(source)) for source, spec in SOURCES.items()}
    replace_batches(quality.check_tables_by_states(facts, as_of, batch_id), layout.checks)
    results = spark.read.parquet(layout.checks).where(F.col("batch_id") == batch_id)
    metrics = run_metrics(run_summary(ingested), results)
    replace_batches(metrics, layout.metrics)
    if enforce:
        quality.gate(results)
    return metrics


def dashboard(spark: SparkSession, layout: Layout, as_of=None) -> DataFrame:
    """The dashboard from the refreshed summary and one pass over the clean tables."""
    a, b = (read_buckets(spark, layout.clean(s), spec) for s, spec in SOURCES.items())
    return analytics.dashboard_of(
        analytics.data_freshness(a, b, as_of), read_table(spark, layout.summary, SUMMARY_SCHEMA), as_of
    )
