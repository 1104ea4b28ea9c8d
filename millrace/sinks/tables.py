"""Tables on plain files: replace as a whole, append, upsert.

A replaceable table is a folder of ``version=N`` folders. Spark marks a finished write with ``_SUCCESS``;
readers take the highest finished version, so they see the old table until the new one is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.clean import clean_full, incremental_slice
from millrace.operators.governance import expired_days
from millrace.operators.merge import merge_newer, merge_newer_small
from millrace.session import workspace
from millrace.sources.stage import list_stage, staged_days
from millrace.specs import SourceSpec

# A slice is broadcast only below both limits; beyond them the merge shuffles.
BROADCAST_ROWS = 500_000
BROADCAST_FILE_BYTES = 32 * 1024 * 1024


def _files(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def drop_folder(spark: SparkSession, path: str) -> None:
    folder, fs = _files(spark, path)
    fs.delete(folder, True)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name; the target must not exist."""
    here, fs = _files(spark, source)
    there, _ = _files(spark, target)
    if fs.exists(there) or not fs.rename(here, there):
        raise RuntimeError(f"{source} can not be moved to {target}")


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none when it does not exist."""
    folder, fs = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has ended."""
    marker, fs = _files(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def purge_expired(spark: SparkSession, stage_root: str, as_of=None, days: int | None = None) -> int:
    """Drop the day folders of a staging area that are past retention; gives their number.

    The driver gets one name per source and expired day. A call that was cut short is made good by the next.
    """
    gone = expired_days(staged_days(spark, stage_root), as_of, days).collect()
    for day in gone:
        drop_folder(spark, f"{stage_root.rstrip('/')}/source={day['source']}/dt={day['dt']}")
    return len(gone)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions, oldest first."""
    numbers = sorted(int(n.split("=")[1]) for n in folder_names(spark, path) if n.startswith("version="))
    return [n for n in numbers if finished(spark, f"{path}/version={n}")]


def read_version(spark: SparkSession, path: str, version: int, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/version={version}")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The current version; an empty table when there is none yet."""
    done = versions(spark, path)
    return read_version(spark, path, done[-1], schema) if done else spark.createDataFrame([], schema)


def replace_table(df: DataFrame, path: str, version: int | None = None, keep: int = 2) -> int:
    """Write the next (or the given) version and drop all but the newest ``keep``."""
    spark = df.sparkSession
    done = versions(spark, path)
    number = (done[-1] + 1 if done else 0) if version is None else version
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    for old in [v for v in done if v != number][: max(len(done) + 1 - keep, 0)]:
        drop_folder(spark, f"{path}/version={old}")
    return number


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_batches(df: DataFrame, path: str) -> None:
    """Write rows by ``batch_id``, in place of those an earlier attempt at the same batch has written."""
    out = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
    out.parquet(path)


def is_small(spark: SparkSession, path: str) -> bool:
    """Whether a written table is safe to broadcast, from Parquet footers and the file listing."""
    size = list_stage(spark, path).agg(F.sum("size")).first()[0] or 0
    return size <= BROADCAST_FILE_BYTES and spark.read.parquet(path).count() <= BROADCAST_ROWS


def merge_slice(target: DataFrame, slice_df: DataFrame, spec: SourceSpec, work: str) -> DataFrame:
    """Upsert a slice into a table, by broadcast when the slice is measured small, else by shuffle.

    The slice is first written to the ``work`` folder: it is read up to three times, and its size is known
    only then. The result reads it from there.
    """
    spark = target.sparkSession
    slice_df.write.mode("overwrite").parquet(work)
    ready = spark.read.schema(spec.clean_schema).parquet(work)
    merge = merge_newer_small if is_small(spark, work) else merge_newer
    return merge(target, ready, spec.key, spec.version)


def replace_by_upsert(target: DataFrame, slice_df: DataFrame, path: str, spec: SourceSpec, version: int | None = None) -> int:
    """Write the upserted table as its next (or the given) version."""
    spark = target.sparkSession
    work = workspace(spark, f"slice-{spec.name}")
    try:
        return replace_table(merge_slice(target, slice_df, spec, work), path, version)
    finally:
        drop_folder(spark, work)


def rebuild(raw: DataFrame, path: str, spec: SourceSpec, as_of=None, tie_break=(), on_error: str = "fail") -> int:
    """Replace the clean table by a full rebuild from RAW."""
    return replace_table(clean_full(raw, spec, as_of, on_error, tie_break), path)


def upsert(raw: DataFrame, path: str, spec: SourceSpec, as_of=None, tie_break=(), on_error: str = "fail") -> int:
    """Bring the clean table up to date with the RAW rows since its last load."""
    target = read_table(raw.sparkSession, path, spec.clean_schema)
    new = incremental_slice(raw, target, spec, as_of, on_error, tie_break)
    return replace_by_upsert(target, new, path, spec)
