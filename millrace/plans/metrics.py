"""Run metrics from request logs, step logs and per-source results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

STEP_LOG_SCHEMA = (
    "source string, batch_id string, step string, row_count bigint, s3_path string, request_duration_ms double, "
    "duration_ms double, retry_count int, status string, error string, timestamp string, level string"
)


def _exact(duration: Column) -> Column:
    """Durations add up exactly as decimals, in whatever order the tasks finish."""
    return duration.cast("decimal(18,6)")


def _two_digits(c: Column) -> Column:
    return F.coalesce(F.round(c, 2).cast("double"), F.lit(0.0))


def request_metrics(requests: DataFrame) -> DataFrame:
    """Requests, failures, retries and durations per source and batch."""
    duration = _exact(F.col("duration_ms"))
    return requests.groupBy("source", "batch_id").agg(
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if("success").alias("successful_requests"),
        F.count_if(~F.col("success")).alias("failed_requests"),
        F.coalesce(F.sum("retry_count"), F.lit(0)).alias("total_retries"),
        _two_digits(F.sum(duration)).alias("total_duration_ms"),
        _two_digits(F.avg(duration)).alias("avg_duration_ms"),
    )


def read_step_logs(spark: SparkSession, path: str) -> DataFrame:
    """Structured log lines; text that is no JSON is left out."""
    return parse_step_logs(spark.read.text(path))


def parse_step_logs(lines: DataFrame, value: str = "value") -> DataFrame:
    record = F.from_json(F.col(value), STEP_LOG_SCHEMA, {"mode": "PERMISSIVE"})
    return lines.select(record.alias("r")).select("r.*").where(F.col("source").isNotNull() & F.col("step").isNotNull())


def step_log_rollup(logs: DataFrame) -> DataFrame:
    """Per source, batch and step: outcome, rows, duration, retries and the newest error.

    A step that ever logged an error is an error, else a success when it finished, else started. Texts are
    compared among the error rows only, as a maximum over texts would make Spark sort every log row.
    """
    failed, succeeded = F.col("status") == "error", F.col("status") == "success"
    duration = _exact(F.coalesce("request_duration_ms", "duration_ms"))
    rolled = logs.groupBy("source", "batch_id", "step").agg(
        F.count(F.lit(1)).alias("log_lines"),
        F.count_if(failed).alias("errors"),
        F.count_if(succeeded).alias("successes"),
        F.max("row_count").alias("row_count"),
        _two_digits(F.sum(duration)).alias("total_duration_ms"),
        F.max("retry_count").alias("retry_count"),
    )
    keys = ("source", "batch_id", "step")
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last("timestamp"), F.desc_nulls_last("error"))
    newest = logs.where(failed).withColumn("nth", F.row_number().over(order)).where("nth = 1")
    newest = newest.select(*(F.col(k).alias(f"e_{k}") for k in keys), F.col("error").alias("last_error"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"e_{k}"))
    rolled = rolled.join(newest, same, "left").drop(*(f"e_{k}" for k in keys))
    status = F.when(F.col("errors") > 0, "error").when(F.col("successes") > 0, "success").otherwise("started")
    return rolled.withColumn("status", status)


def run_summary(results: DataFrame) -> DataFrame:
    """Per batch over its sources: records fetched and staged, and whether all went well."""
    ok = F.coalesce(F.col("status") == "success", F.lit(False))
    return results.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("sources"),
        F.coalesce(F.sum("records_fetched"), F.lit(0)).alias("total_records_fetched"),
        F.coalesce(F.sum("records_staged"), F.lit(0)).alias("total_records_staged"),
        F.when(F.bool_and(ok), "success").otherwise("partial_failure").alias("status"),
    )


def run_metrics(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Run summary with the run's check counts; 0 where a run has no checks."""
    checks = results.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )
    return runs.join(checks, "batch_id", "left").fillna(0, ["total_checks", "passed", "failed"])
