"""Clean tables in key buckets: an upsert reads and rewrites only the buckets its slice falls into.

A row lies in the folder of its key's hash, ``bucket=0007-of-0064``; the number of buckets belongs to the table and is
read from the folder names. Rows without a key match nothing, so each load keeps its own in a folder ``bucket=null-7``.

A load is two steps. First the merged rows of the touched buckets are written beside the table. Then Spark's dynamic
partition overwrite puts them in place of those buckets, and no other file is touched. A load that was cut short is
repeated from the rows beside the table, not from buckets that may be half replaced; a finished one is not repeated.
While a load is put in place, readers may see some of its buckets and not yet the others. A table has one writer.

Beside the table lie small states of each bucket: counts per day, and the facts the quality checks need. They are
renewed for the touched buckets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.merge import merge_newer, merge_newer_small
from millrace.sinks.tables import drop_folder, finished, folder_names, is_small
from millrace.specs import SourceSpec

BUCKET, LOAD = "bucket", "load_id"
BUCKETS = 64
DAYS_SCHEMA = "event_date date, event_count bigint, unique_records bigint, bucket string"
FACTS_SCHEMA = "n_rows bigint, nulls bigint, repeated bigint, latest timestamp_ntz, bucket string"


def bucket_of(key: str, buckets: int, load_id: int) -> Column:
    """The folder of a row."""
    number = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("string")
    named = F.concat(F.lpad(number, 4, "0"), F.lit(f"-of-{buckets:04d}"))
    return F.when(F.col(key).isNull(), F.lit(f"null-{load_id}")).otherwise(named)


def bucket_names(spark: SparkSession, path: str) -> list[str]:
    """Folders of a table, from one listing."""
    return [n.split("=", 1)[1] for n in folder_names(spark, path) if n.startswith(f"{BUCKET}=")]


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """How many key buckets a table was laid out in; None before its first load."""
    found = {int(n.split("-of-")[1]) for n in bucket_names(spark, path) if "-of-" in n}
    if len(found) > 1:
        raise RuntimeError(f"{path} has folders of several layouts: {sorted(found)}")
    return found.pop() if found else None


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    there = bucket_names(spark, path)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)


def read_buckets(spark: SparkSession, path: str, spec: SourceSpec) -> DataFrame:
    """The table; empty before its first load."""
    return _read(spark, path, f"{spec.clean_schema}, {BUCKET} string").select(*spec.clean_columns)


def day_states(spark: SparkSession, path: str) -> DataFrame:
    """Rows and ids per bucket and day."""
    return _read(spark, f"{path}_days", DAYS_SCHEMA)


def fact_states(spark: SparkSession, path: str) -> DataFrame:
    """Rows, rows without a key, repeated keys and newest row per bucket."""
    return _read(spark, f"{path}_facts", FACTS_SCHEMA)


def loads(spark: SparkSession, path: str) -> list[int]:
    """Finished loads."""
    numbers = [int(n.split("=")[1]) for n in folder_names(spark, f"{path}_loads") if n.startswith(f"{LOAD}=")]
    return sorted(n for n in numbers if finished(spark, f"{path}_loads/{LOAD}={n}"))


def _replace(df: DataFrame, path: str) -> None:
    """Put rows in place of the buckets they fall into."""
    out = df.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(BUCKET).parquet(path)


def days_of(rows: DataFrame, key: str, clock: str = "created_at") -> DataFrame:
    """Counts per bucket and day. A bucket of upserted rows holds each key once."""
    return rows.groupBy(BUCKET, F.to_date(clock).alias("event_date")).agg(
        F.count(F.lit(1)).alias("event_count"), F.count(key).alias("unique_records")
    )


def facts_of(rows: DataFrame, key: str) -> DataFrame:
    """What the checks need per bucket. Equal keys share a bucket, so repeated keys of buckets add up."""
    per_key = rows.groupBy(BUCKET, F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("latest"))
    is_null = F.col("k").isNull()
    return per_key.groupBy(BUCKET).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(is_null, F.col("n")).otherwise(0)).alias("nulls"),
        F.count_if(~is_null & (F.col("n") > 1)).alias("repeated"),
        F.max("latest").alias("latest"),
    )


def _merged(spark: SparkSession, slice_df: DataFrame, path: str, spec: SourceSpec, load_id: int, buckets: int, work: str) -> None:
    """Write the touched buckets as they will be to ``work``."""
    schema = f"{spec.clean_schema}, {BUCKET} string"
    named = slice_df.select(*spec.clean_columns).withColumn(BUCKET, bucket_of(spec.key, buckets, load_id))
    named.write.mode("overwrite").parquet(f"{work}/slice")
    ready = spark.read.schema(schema).parquet(f"{work}/slice")
    # At most one name per key bucket and one for rows without a key.
    touched = [r[0] for r in ready.select(BUCKET).distinct().collect()]
    keyed, lost = ready.where(F.col(spec.key).isNotNull()), ready.where(F.col(spec.key).isNull())
    # The names prune folders at the scan.
    target = _read(spark, path, schema).where(F.col(BUCKET).isin(touched)).where(F.col(spec.key).isNotNull())
    merge = merge_newer_small if is_small(spark, f"{work}/slice") else merge_newer
    merged = merge(target, keyed, spec.key, spec.version).unionByName(lost)
    merged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{work}/merged")


def upsert_buckets(slice_df: DataFrame, path: str, spec: SourceSpec, load_id: int, buckets: int = BUCKETS) -> bool:
    """Upsert a slice with one row per key; False when this load was finished before.

    ``buckets`` is taken for a new table; an existing one keeps its own.
    """
    spark = slice_df.sparkSession
    mark, work = f"{path}_loads/{LOAD}={load_id}", f"{path}_pending/{LOAD}={load_id}"
    if finished(spark, mark):
        return False
    buckets = bucket_count(spark, path) or buckets
    if not finished(spark, f"{work}/merged"):
        _merged(spark, slice_df, path, spec, load_id, buckets, work)
    rows = spark.read.schema(f"{spec.clean_schema}, {BUCKET} string").parquet(f"{work}/merged")
    for part, where in ((days_of(rows, spec.key), f"{path}_days"), (facts_of(rows, spec.key), f"{path}_facts"), (rows, path)):
        _replace(part, where)
    touched = rows.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n_rows"))
    touched.write.mode("overwrite").parquet(mark)
    drop_folder(spark, work)
    return True


def rebuild_states(spark: SparkSession, path: str, spec: SourceSpec) -> None:
    """States of every bucket, from the whole table."""
    rows = _read(spark, path, f"{spec.clean_schema}, {BUCKET} string")
    for part, where in ((days_of(rows, spec.key), f"{path}_days"), (facts_of(rows, spec.key), f"{path}_facts")):
        part.write.mode("overwrite").partitionBy(BUCKET).parquet(where)
