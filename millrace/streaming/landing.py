"""Landing: every staged file is loaded into RAW exactly once, and its load is recorded.

Each line is parsed once and written once, in folders by its kind: ``kind=good`` is the RAW table, ``kind=bad`` keeps
lines that are no JSON as they are, and ``kind=blank`` only says where lines without content stood. Counters and first
errors of every file come from the columns just written and go to the history table, ``<raw_path>_history``, so nobody
has to parse staged files again to see what became of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from millrace.functions.text import is_blank
from millrace.functions.timefn import as_of_column
from millrace.operators.days import INGEST_DAY, ingested
from millrace.sources.jsonl import BAD_JSON, batch_of, history_of_splits, staged_name
from millrace.specs import RAW_SCHEMA

KIND = "kind"  # folder of RAW, above the one by ingest day
GOOD, BAD, BLANK = "good", "bad", "blank"
PLACE = "block_start bigint, pos bigint"
HISTORY_SCHEMA = (
    "file_name string, status string, row_parsed bigint, row_count bigint, error_count bigint, "
    "first_error_message string, first_error_line_number bigint, last_load_time timestamp_ntz, load_id string"
)


def landed_rows(lines: DataFrame, source: str, as_of=None, legacy_batch_id: bool = False, on_error: str = "continue") -> DataFrame:
    """RAW rows of text lines with ``file_path`` and ``block_start``; bad and blank ones have no payload.

    ``pos`` grows within a file split. Lines must come straight from the files.
    """
    name = staged_name(F.col("file_path"))
    blank = is_blank(F.col("value"))
    parse = F.parse_json if on_error == "fail" else F.try_parse_json
    rows = lines.select(
        F.when(~blank, parse("value")).alias("payload"),
        F.lit(source).alias("source"),
        as_of_column(as_of).alias("ingested_at"),
        batch_of(name, legacy_batch_id).alias("batch_id"),
        name.alias("file_name"),
        F.when(blank, F.lit("")).otherwise(F.col("value")).alias("line"),
        "block_start",
        F.monotonically_increasing_id().alias("pos"),
    )
    kind = F.when(F.col("line") == "", BLANK).when(F.col("payload").isNull(), BAD).otherwise(GOOD)
    rows = rows.withColumns({KIND: kind, INGEST_DAY: F.to_date("ingested_at")})
    return rows.withColumn("line", F.when(F.col(KIND) == BAD, F.col("line")))


def land(
    spark: SparkSession,
    stage_root: str,
    source: str,
    raw_path: str,
    checkpoint: str,
    as_of=None,
    legacy_batch_id: bool = False,
    on_error: str = "continue",
    max_files: int | None = None,
    every: str | None = None,
):
    """Load the files that are new since the last call and return the query.

    By default it runs once over all that is new (in steps of ``max_files``); with ``every`` it keeps
    running at that interval. Each micro-batch owns a ``load_id`` folder and overwrites it when
    replayed, which together with the checkpoint makes the load exactly-once. Its rows lie in folders by
    ingest day, so that ``read_raw`` opens no older days than it needs. Lines that are no JSON are kept for
    ``read_rejected``, or fail the load with ``on_error="fail"``.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    meta = [F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "file_path"), ("file_block_start", "block_start"))]
    lines = reader.load(f"{stage_root.rstrip('/')}/source={source}").select("value", *meta)

    def load(batch: DataFrame, load_id: int) -> None:
        session, folder = batch.sparkSession, f"{raw_path}/load_id={load_id}"
        rows = landed_rows(batch, source, as_of, legacy_batch_id, on_error)
        rows.write.mode("overwrite").partitionBy(KIND, INGEST_DAY).parquet(folder)
        written = session.read.schema(f"file_name string, ingested_at timestamp_ntz, {PLACE}, {KIND} string").parquet(folder)
        load_history_of(written).write.mode("overwrite").parquet(f"{raw_path}_history/load_id={load_id}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return lines.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def load_history_of(written: DataFrame) -> DataFrame:
    """History of files from the places and kinds of their lines; no payload is read."""
    bad = F.col(KIND) == BAD
    per_split = written.groupBy("file_name", "block_start").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col(KIND) != BLANK).alias("records"),
        F.count_if(bad).alias("errors"),
        (F.min(F.when(bad, F.col("pos"))) - F.min("pos") + 1).alias("bad_at"),
        F.max("ingested_at").alias("loaded_at"),
    )
    return history_of_splits(per_split)


def _landed(spark: SparkSession, raw_path: str, *more: StructField) -> DataFrame:
    folders = [StructField(KIND, StringType()), StructField(INGEST_DAY, DateType())]
    return spark.read.schema(StructType([*RAW_SCHEMA, *more, *folders])).parquet(raw_path)


def read_raw(spark: SparkSession, raw_path: str, since=None, days: bool = False) -> DataFrame:
    """The RAW table without its load folders; with ``since`` the rows ingested at or after it, older days unopened.

    With ``days`` the column ``ingest_day`` stays, so that later bounds on the ingest time reach the folders too.
    """
    rows = _landed(spark, raw_path).where(F.col(KIND) == GOOD)
    if since is not None:
        rows = ingested(rows, as_of_column(since))
    return rows.select(*RAW_SCHEMA.fieldNames(), *([INGEST_DAY] if days else []))


def read_rejected(spark: SparkSession, raw_path: str) -> DataFrame:
    """Lines that were no JSON, whole, with their file and time."""
    rows = _landed(spark, raw_path, StructField("line", StringType())).where(F.col(KIND) == BAD)
    return rows.select("source", "file_name", "line", F.lit(BAD_JSON).alias("error"), F.col("ingested_at").alias("rejected_at"))


def read_history(spark: SparkSession, raw_path: str) -> DataFrame:
    """What every load did with every file; ``sources.jsonl.failed_loads`` picks those not fully loaded."""
    return spark.read.schema(HISTORY_SCHEMA).parquet(f"{raw_path}_history")
