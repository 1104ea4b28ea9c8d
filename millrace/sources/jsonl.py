"""JSON-lines input: one record per line, with bad lines kept apart and counted per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.functions.text import is_blank

BAD_JSON = "not a JSON value"

# Load states.
LOADED, PARTIAL, FAILED = "Loaded", "Partially loaded", "Load failed"


def staged_name(file_path: Column) -> Column:
    """A file's name from the ``source=`` folder on, as recorded in RAW."""
    return F.regexp_extract(file_path, r"(source=.*)$", 1)


def batch_of(file_name: Column, legacy: bool = False) -> Column:
    """Batch id in a staged file name; ``legacy`` keeps the file's own name behind it."""
    tail = F.split_part(file_name, F.lit("batch_id="), F.lit(2))
    return tail if legacy else F.split_part(tail, F.lit("/"), F.lit(1))


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All lines below a path: ``value`` plus where each came from."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    )


def parsed(lines: DataFrame, value: str = "value") -> DataFrame:
    """Add ``payload``, NULL where the line is no JSON; blank lines are left out."""
    return lines.where(~is_blank(F.col(value))).withColumn("payload", F.try_parse_json(value))


def read_jsonl(spark: SparkSession, path: str | list[str], on_error: str = "fail") -> DataFrame:
    """One VARIANT ``payload`` per line. A malformed line raises, or is left out with ``"continue"``."""
    lines = text_lines(spark, path).where(~is_blank(F.col("value")))
    if on_error == "fail":
        return lines.select(F.parse_json("value").alias("payload"), "file_path")
    good = lines.withColumn("payload", F.try_parse_json("value")).where(F.col("payload").isNotNull())
    return good.select("payload", "file_path")


def load_errors(lines: DataFrame) -> DataFrame:
    """Lines that are no JSON, whole, with their file."""
    bad = parsed(lines).where(F.col("payload").isNull())
    return bad.select(
        staged_name(F.col("file_path")).alias("file_name"), F.col("value").alias("line"), F.lit(BAD_JSON).alias("error")
    )


def load_history(lines: DataFrame) -> DataFrame:
    """Per file: rows parsed and rejected, state, first error with its line number, time of the file.

    For staged files that are not landed; landing keeps a history of its own (`streaming.landing.read_history`).

    Lines carry no number. Within a file split rows keep their order, so the position of the first
    bad line in its split plus the lines of all earlier splits gives its number; only one small row per
    split is shuffled. ``lines`` must come straight from `text_lines`.
    """
    numbered = lines.select(
        "file_path",
        "block_start",
        "modified_at",
        F.monotonically_increasing_id().alias("pos"),
        is_blank(F.col("value")).alias("blank"),
        F.try_parse_json("value").isNull().alias("unparsed"),
    )
    bad = ~F.col("blank") & F.col("unparsed")
    per_split = numbered.groupBy("file_path", "block_start").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(~F.col("blank")).alias("records"),
        F.count_if(bad).alias("errors"),
        (F.min(F.when(bad, F.col("pos"))) - F.min("pos") + 1).alias("bad_at"),
        F.max("modified_at").alias("loaded_at"),
    )
    named = per_split.select(staged_name(F.col("file_path")).alias("file_name"), *per_split.columns[1:])
    return history_of_splits(named)


def history_of_splits(per_split: DataFrame) -> DataFrame:
    """Per file, from one row per split: lines, records, errors, place of the first bad line in it, load time."""
    before = Window.partitionBy("file_name").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    placed = per_split.withColumn("bad_at", F.col("bad_at") + F.coalesce(F.sum("lines").over(before), F.lit(0)))
    per_file = placed.groupBy("file_name").agg(
        F.sum("records").alias("row_parsed"),
        F.sum("errors").alias("error_count"),
        F.min("bad_at").alias("first_error_line_number"),
        F.max("loaded_at").cast("timestamp_ntz").alias("last_load_time"),
    )
    loaded = F.col("row_parsed") - F.col("error_count")
    return per_file.select(
        "file_name",
        load_state(loaded, F.col("error_count")).alias("status"),
        "row_parsed",
        loaded.alias("row_count"),
        "error_count",
        F.when(F.col("error_count") > 0, F.lit(BAD_JSON)).alias("first_error_message"),
        "first_error_line_number",
        "last_load_time",
    )


def load_state(loaded: Column, errors: Column) -> Column:
    return F.when(errors == 0, LOADED).when(loaded > 0, PARTIAL).otherwise(FAILED)


def failed_loads(history: DataFrame, since: Column | None = None) -> DataFrame:
    """Files not fully loaded, newest first."""
    rows = history.where(F.col("status") != LOADED)
    if since is not None:
        rows = rows.where(F.col("last_load_time") >= since)
    return rows.orderBy(F.desc_nulls_first("last_load_time"), "file_name")
