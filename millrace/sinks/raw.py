"""Upkeep of RAW: small loads packed into large files, days past retention dropped.

Landing leaves one folder per load and day. `compact_raw` rewrites the finished days of many loads into one load folder
of its own, ``load_id=c<N>``, with few large files, and drops the folders it has read. Rows keep all their columns, so
history, places of bad lines and time bounds stay as they were.

The swap is made so that a reader or a stream loses nothing and a call that was cut short is made good by the next:
the packed rows are written beside RAW, a marker names the folders they replace, the old folders are dropped, and the
packed folder is moved in last. Between the last two steps the rows are in the pending folder, which a repeated call
moves in. A stream that upserts RAW keeps its own list of files and would take packed rows for new ones, so it skips
``load_id=c`` folders; pack only ``loads`` that it has taken already, as `plans.runs.run_hourly` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from millrace.functions.timefn import as_of_column, minus
from millrace.operators.days import INGEST_DAY
from millrace.operators.governance import RETENTION_DAYS
from millrace.sinks.tables import drop_folder, finished, folder_names, move_folder
from millrace.specs import RAW_SCHEMA

PACKED = "c"  # first letter of packed load ids
KIND, LOAD = "kind", "load_id"
COLUMNS = StructType([*RAW_SCHEMA, StructField("line", StringType()), StructField("block_start", LongType()), StructField("pos", LongType())])
FOLDERS = StructType([StructField(LOAD, StringType()), StructField(KIND, StringType()), StructField(INGEST_DAY, DateType())])
# Rows of a packed file; Spark starts a new one beyond it.
FILE_ROWS = 2_000_000


def _raw(spark: SparkSession, raw_path: str) -> DataFrame:
    return spark.read.schema(StructType([*COLUMNS, *FOLDERS])).parquet(raw_path)


def load_ids(spark: SparkSession, raw_path: str) -> list[str]:
    """Loads that RAW has now."""
    return [n.split("=", 1)[1] for n in folder_names(spark, raw_path) if n.startswith(f"{LOAD}=")]


def day_folders(spark: SparkSession, raw_path: str) -> list[tuple[str, str, str]]:
    """``(load_id, kind, ingest_day)`` of every folder, from listings alone."""
    out = []
    for load in folder_names(spark, raw_path):
        for kind in folder_names(spark, f"{raw_path}/{load}") if load.startswith(f"{LOAD}=") else ():
            days = folder_names(spark, f"{raw_path}/{load}/{kind}") if kind.startswith(f"{KIND}=") else ()
            out += [tuple(n.split("=", 1)[1] for n in (load, kind, day)) for day in days if day.startswith(f"{INGEST_DAY}=")]
    return sorted(out)


def _folder(raw_path: str, load: str, kind: str, day: str) -> str:
    return f"{raw_path}/{LOAD}={load}/{KIND}={kind}/{INGEST_DAY}={day}"


def _limit(spark: SparkSession, as_of, days: int) -> str:
    """The day ``days`` before a time, as text."""
    return spark.range(1).select(F.date_format(minus(as_of_column(as_of), days=days), "yyyy-MM-dd")).first()[0]


def purge_raw(spark: SparkSession, raw_path: str, as_of=None, days: int | None = None) -> int:
    """Drop the day folders of RAW that are past retention whole; gives their number.

    A day goes only when all of it is past, so no row that is still kept is lost.
    """
    limit = _limit(spark, as_of, RETENTION_DAYS["raw"] if days is None else days)
    gone = [f for f in day_folders(spark, raw_path) if f[2] < limit]
    for load, kind, day in gone:
        drop_folder(spark, _folder(raw_path, load, kind, day))
    return len(gone)


def compact_raw(spark: SparkSession, raw_path: str, as_of=None, least: int = 2, loads: Sequence[str] | None = None) -> int:
    """Pack the days before today that lie in ``least`` or more load folders; gives the number of folders replaced.

    Of all loads, or of ``loads`` and those packed before.
    """
    pending = f"{raw_path}_packing"
    done = _swap(spark, raw_path, pending) if finished(spark, f"{pending}/replaced") else 0
    today = _limit(spark, as_of, 0)
    found: dict[tuple[str, str], list[str]] = {}
    for load, kind, day in day_folders(spark, raw_path):
        if day < today and (loads is None or load in loads or load.startswith(PACKED)):
            found.setdefault((kind, day), []).append(load)
    found = {k: v for k, v in found.items() if len(v) >= least}
    if not found:
        return done
    drop_folder(spark, pending)
    numbers = [int(n[len(PACKED) :]) for n in load_ids(spark, raw_path) if n.startswith(PACKED)]
    number = max(numbers, default=-1) + 1
    replaced = [(load, kind, day) for (kind, day), loads in found.items() for load in loads]
    # The folders to pack, one short row each; files of all other folders are not opened.
    wanted = spark.createDataFrame(replaced, f"{LOAD} string, {KIND} string, {INGEST_DAY} string")
    days = [F.lit(d).cast("date") for d in sorted({day for _, _, day in replaced})]
    rows = _raw(spark, raw_path).where(F.col(INGEST_DAY).isin(*days)).join(
        F.broadcast(wanted.withColumn(INGEST_DAY, F.col(INGEST_DAY).cast("date"))), [LOAD, KIND, INGEST_DAY], "left_semi"
    )
    packed = rows.drop(LOAD).hint("rebalance", KIND, INGEST_DAY)
    packed.write.option("maxRecordsPerFile", FILE_ROWS).partitionBy(KIND, INGEST_DAY).parquet(f"{pending}/{LOAD}={PACKED}{number}")
    wanted.coalesce(1).write.parquet(f"{pending}/replaced")
    return done + _swap(spark, raw_path, pending)


def _swap(spark: SparkSession, raw_path: str, pending: str) -> int:
    """Drop what the packed rows replace and move them in. Each step may be repeated."""
    replaced = spark.read.schema(f"{LOAD} string, {KIND} string, {INGEST_DAY} string").parquet(f"{pending}/replaced").collect()
    for load, kind, day in replaced:
        drop_folder(spark, _folder(raw_path, load, kind, day))
    for name in folder_names(spark, pending):
        if name.startswith(f"{LOAD}="):
            move_folder(spark, f"{pending}/{name}", f"{raw_path}/{name}")
    drop_folder(spark, pending)
    return len(replaced)
