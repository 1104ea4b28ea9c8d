"""Continuous upsert of landed rows into a clean table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.clean import clean_full
from millrace.sinks.buckets import BUCKETS, upsert_buckets
from millrace.sinks.raw import PACKED
from millrace.specs import RAW_SCHEMA, SourceSpec


def stream_upsert(
    spark: SparkSession,
    raw_path: str,
    clean_path: str,
    checkpoint: str,
    spec: SourceSpec,
    as_of=None,
    tie_break=(),
    on_error: str = "fail",
    max_files: int | None = None,
    every: str | None = None,
    buckets: int = BUCKETS,
):
    """Upsert RAW rows as they land into a table of key buckets and return the query.

    Which rows are new is the checkpoint's knowledge, so late-committed rows are not lost as with a
    clock. Micro-batch N is load N of the table: it rewrites the buckets its keys fall into, and one that is
    replayed finds its load finished and does nothing. The stream must be the table's only writer.
    """
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.option("recursiveFileLookup", "true").parquet(raw_path).withColumn("_path", F.col("_metadata.file_path"))

    def apply(batch: DataFrame, batch_id: int) -> None:
        # Landing keeps the places of bad and blank lines in RAW too; these have no payload.
        # Packed loads hold rows that were offered before.
        packed = F.col("_path").contains(f"/load_id={PACKED}")
        rows = batch.where(F.col("payload").isNotNull() & ~packed).drop("_path")
        upsert_buckets(clean_full(rows, spec, as_of, on_error, tie_break), clean_path, spec, batch_id, buckets)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**trigger).start()
