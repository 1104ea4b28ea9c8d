"""Staging writers: records plus batch columns as JSON lines or Parquet, and a report of the write."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from millrace.functions import variants as V
from millrace.functions.timefn import ISO_MICROS, as_of_column, format_ts
from millrace.sources.stage import LAYOUT, list_stage, staging_path

# to_json would drop null fields and cut timestamps to milliseconds.
JSON_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": ISO_MICROS,
    "timestampNTZFormat": ISO_MICROS,
}


def new_batch_id() -> Column:
    """Twelve hex characters."""
    return F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 12)


def _as_column(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def _batch_columns(batch_id: Column, source: Column | None, at: Column, schema_version: str | None) -> dict[str, Column]:
    columns = {"_batch_id": batch_id}
    if source is not None:
        columns["_source"] = source
    columns["_extracted_at"] = format_ts(at)
    if schema_version is not None:
        columns["_schema_version"] = F.lit(schema_version)
    return columns


def with_batch_columns(
    df: DataFrame, batch_id: Column | str, at: Column, source: Column | str | None = None, schema_version: str | None = None
) -> DataFrame:
    """Batch columns in front of a typed record; a column the record already has keeps its value."""
    source = None if source is None else _as_column(source)
    extra = _batch_columns(_as_column(batch_id), source, at, schema_version)
    return df.select(*[c.alias(n) for n, c in extra.items() if n not in df.columns], *df.columns)


def json_line(
    df: DataFrame, batch_id: Column, at: Column, source: Column | None, schema_version: str | None, payload: str | None
) -> Column:
    """One JSON text per record. Record fields override batch columns of the same name."""
    extra = _batch_columns(batch_id, source, at, schema_version)
    if payload:
        batch = F.create_map(*[x for n, c in extra.items() for x in (F.lit(n), c.cast("variant"))])
        record = F.try_variant_get(F.col(payload), "$", V.ENTRIES)
        return F.to_json(F.to_variant_object(F.map_concat(batch, record)))
    own = [F.col(f"`{c}`") for c in df.columns]
    fields = [c.alias(n) for n, c in extra.items() if n not in df.columns] + own
    return F.to_json(F.struct(*fields), JSON_OPTIONS)


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("record_count")), seen


def stage(
    df: DataFrame,
    root: str,
    source: Column | str,
    batch_id: Column | str,
    at: Column | str | None = None,
    payload: str | None = None,
    schema_version: str | None = None,
) -> dict:
    """Write JSON lines under ``source=/dt=/hour=/batch_id=`` and report on it.

    ``source``, ``batch_id`` and ``at`` are constants or columns of ``df``. Writing a batch again replaces
    it; an empty input writes no batch. Rows are rebalanced by target folder: Spark splits folders that
    hold much and packs small ones, so neither a hot batch nor many tiny files slow the write.
    """
    # The spread of a single batch is the input's own; only mixed batches need gathering.
    mixed = any(isinstance(x, Column) for x in (source, batch_id, at))
    if not mixed:
        at = dt.datetime.fromisoformat(str(at)) if at else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    target = root if mixed else staging_path(root, source, at, batch_id=batch_id)
    source, batch_id, when = _as_column(source), _as_column(batch_id), as_of_column(at)
    lines = df.select(
        json_line(df, batch_id, when, source, schema_version, payload).alias("value"),
        source.alias("source"),
        F.date_format(when, "yyyy-MM-dd").alias("dt"),
        F.date_format(when, "HH").alias("hour"),
        batch_id.alias("batch_id"),
    )
    lines, seen = _observed(lines)
    out = lines.hint("rebalance", *LAYOUT) if mixed else lines
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*LAYOUT).text(root)
    return {"path": target, "record_count": seen.get["record_count"], "schema_version": schema_version}


def write_jsonl(
    df: DataFrame, path: str, batch_id: Column | str, at=None, payload: str | None = None, schema_version: str = "1.0"
) -> dict:
    """Write JSON lines into one folder, without partitions or a source column."""
    when = as_of_column(at)
    line = json_line(df, _as_column(batch_id), when, None, schema_version, payload)
    lines, seen = _observed(df.select(line.alias("value")))
    lines.write.mode("overwrite").text(path)
    return {"path": path, "record_count": seen.get["record_count"], "schema_version": schema_version}


def write_parquet(df: DataFrame, path: str, batch_id: Column | str, at=None, schema_version: str = "1.0") -> dict:
    """Write typed records with their batch columns as Parquet."""
    rows, seen = _observed(with_batch_columns(df, batch_id, as_of_column(at), schema_version=schema_version))
    rows.write.mode("overwrite").parquet(path)
    return {"path": path, "record_count": seen.get["record_count"], "schema_version": schema_version}


def write_report(spark: SparkSession, report: dict, batch_id: str, extracted_at: str, source: str | None = None) -> DataFrame:
    """The report of one write as a row, with file count and bytes from the file listing."""
    head = spark.createDataFrame(
        [(report["path"], source, batch_id, extracted_at, report["schema_version"], report["record_count"])],
        T.StructType.fromDDL(
            "path string, source string, batch_id string, extracted_at string, schema_version string, record_count bigint"
        ),
    )
    # Both sides are one row.
    sizes = list_stage(spark, report["path"]).where(F.col("size") > 0)
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).scalar()
    return head.withColumn("file_size_bytes", total)
