"""The staging area: ``source=/dt=/hour=/batch_id=`` folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sources.jsonl import staged_name

LAYOUT = ("source", "dt", "hour", "batch_id")


def staging_path(root: str, source: str, dt=None, hour: int | None = None, batch_id: str | None = None) -> str:
    """Folder of a source, day, hour or batch; ``dt`` is a date or datetime."""
    parts = [root.rstrip("/"), f"source={source}"]
    if dt is not None:
        hour = getattr(dt, "hour", None) if hour is None else hour
        parts.append(f"dt={dt:%Y-%m-%d}")
        if hour is not None:
            parts.append(f"hour={hour:02d}")
            if batch_id is not None:
                parts.append(f"batch_id={batch_id}")
    return "/".join(parts)


def staged_lines(spark: SparkSession, root: str) -> DataFrame:
    """Lines with their partition columns, all strings; filters on those prune folders."""
    schema = "value string, source string, dt string, hour string, batch_id string"
    return spark.read.schema(schema).text(root)


def read_staged(spark: SparkSession, root: str, source: str | None = None, dt_from: str | None = None) -> DataFrame:
    """Parsed records of the staging area, only the asked-for folders being read."""
    lines = staged_lines(spark, root)
    if source is not None:
        lines = lines.where(F.col("source") == source)
    if dt_from is not None:
        lines = lines.where(F.col("dt") >= dt_from)
    return lines.select(F.parse_json("value").alias("payload"), *LAYOUT)


def staged_days(spark: SparkSession, root: str) -> DataFrame:
    """``source`` and ``dt`` of every file in a day folder, from the file listing; no line is read."""
    name = F.col("file_name")
    part = lambda key, form: F.regexp_extract(name, rf"(?:^|/){key}=({form})/", 1).alias(key)
    days = list_stage(spark, root).select(part("source", "[^/]+"), part("dt", r"\d{4}-\d{2}-\d{2}"))
    return days.where("source <> '' and dt <> ''")


def list_stage(spark: SparkSession, path: str) -> DataFrame:
    """Files below a path with size and time, from the file listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        staged_name(F.col("path")).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )
