"""Data-quality checks on the clean tables, their reports and the gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.timefn import as_of_column, boundary_diff, minus
from millrace.specs import SourceSpec

FRESH_HOURS = 6

# Checks whose failure stops a run.
CRITICAL_CHECKS = ("null_primary_key_check", "duplicate_primary_key_check")

RESULT_COLUMNS = (
    "check_id",
    "check_name",
    "check_type",
    "table_name",
    "check_sql",
    "result_value",
    "threshold_value",
    "passed",
    "error_message",
    "executed_at",
    "batch_id",
)

NUMBER = "decimal(38,0)"


def _check(name: str, kind: str, value: Column, limit: int, passed: Column, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(kind).alias("check_type"),
        value.cast(NUMBER).alias("result_value"),
        F.lit(limit).cast(NUMBER).alias("threshold_value"),
        passed.alias("passed"),
        message.alias("error_message"),
    )


def _found(n: Column, what: str) -> Column:
    return F.when(n > 0, F.concat(F.lit("Found "), n.cast("string"), F.lit(what)))


def check_table(df: DataFrame, table_name: str, as_of=None, key: str = "id", batch_id: str | None = None) -> DataFrame:
    """All four checks of a table from one scan.

    Rows are counted per key, combined in each task before the shuffle, so a hot key stays small; the
    table's row count, NULL keys, newest row and repeated keys all follow from those counts.
    """
    per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("ingested_at").alias("latest"))
    facts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.max("latest").alias("latest"),
    )
    return _checks_of(facts, table_name, as_of, batch_id)


def check_states(states: DataFrame, table_name: str, as_of=None, batch_id: str | None = None) -> DataFrame:
    """The same checks from the states of a table's buckets (`sinks.buckets.fact_states`); no row of it is read.

    Equal keys share a bucket, so numbers of repeated keys add up. Rows without a key lie in several buckets and are
    one key.
    """
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    facts = states.agg(
        total("n_rows").alias("n_rows"),
        total("nulls").alias("nulls"),
        (total("repeated") + F.when(total("nulls") > 1, 1).otherwise(0)).alias("repeated"),
        F.max("latest").alias("latest"),
    )
    return _checks_of(facts, table_name, as_of, batch_id)


def _checks_of(facts: DataFrame, table_name: str, as_of, batch_id: str | None) -> DataFrame:
    """A row per check from one row of facts."""
    now = as_of_column(as_of)
    facts = facts.withColumn("age", boundary_diff("HOUR", F.col("latest"), now))
    rows, nulls, repeated, age = (F.col(c) for c in ("n_rows", "nulls", "repeated", "age"))
    old = F.concat(F.lit("Data is "), age.cast("string"), F.lit(f" hours old (threshold: {FRESH_HOURS} hours)"))
    # Names, types, limits and messages of the checks.
    checks = F.array(
        _check(
            "row_count_check", "completeness", rows, 1, rows > 0,
            F.when(rows == 0, F.lit("Table is empty - no records found")),
        ),
        _check(
            "null_primary_key_check", "validity", nulls, 0, nulls == 0, _found(nulls, " records with NULL id")
        ),
        # With no data the age is NULL, so the check neither passes nor fails.
        _check(
            "freshness_check", "timeliness", age, FRESH_HOURS, age <= FRESH_HOURS,
            F.when(F.col("latest").isNull(), F.lit("No data found - cannot check freshness")).when(age > FRESH_HOURS, old),
        ),
        _check(
            "duplicate_primary_key_check", "uniqueness", repeated, 0, repeated == 0,
            _found(repeated, " duplicate id values"),
        ),
    )
    return (
        facts.select(F.explode(checks).alias("c"))
        .select("c.*")
        .select(
            F.uuid().alias("check_id"),
            "check_name",
            "check_type",
            F.lit(table_name).alias("table_name"),
            F.lit(None).cast("string").alias("check_sql"),
            "result_value",
            "threshold_value",
            "passed",
            "error_message",
            now.alias("executed_at"),
            F.lit(batch_id).cast("string").alias("batch_id"),
        )
    )


def check_tables(tables: dict[SourceSpec, DataFrame], as_of=None, batch_id: str | None = None) -> DataFrame:
    out = None
    for spec, df in tables.items():
        part = check_table(df, spec.qualified_table, as_of, spec.key, batch_id)
        out = part if out is None else out.unionByName(part)
    return out


def check_tables_by_states(states: dict[SourceSpec, DataFrame], as_of=None, batch_id: str | None = None) -> DataFrame:
    out = None
    for spec, df in states.items():
        part = check_states(df, spec.qualified_table, as_of, batch_id)
        out = part if out is None else out.unionByName(part)
    return out


def recent(results: DataFrame, as_of=None, hours: int = 0, minutes: int = 0, batch_id: str | None = None) -> DataFrame:
    """Results of a time window ending now, or of one run when ``batch_id`` is given."""
    if batch_id is not None:
        return results.where(F.col("batch_id") == batch_id)
    return results.where(F.col("executed_at") >= minus(as_of_column(as_of), hours=hours, minutes=minutes))


def latest_results(results: DataFrame, as_of=None, batch_id: str | None = None) -> DataFrame:
    rows = recent(results, as_of, hours=1, batch_id=batch_id).select(
        "check_name", "check_type", "table_name", "result_value", "threshold_value", "passed", "error_message", "executed_at"
    )
    return rows.orderBy(F.desc_nulls_first("executed_at"), "table_name", "check_name")


def summary(results: DataFrame, as_of=None, batch_id: str | None = None) -> DataFrame:
    """Counts and pass rate of the last hour. A check that could not be judged is ``unknown``.

    Over no results the sums and the rate are NULL.
    """
    passed, failed = F.col("passed"), ~F.col("passed")
    counts = recent(results, as_of, hours=1, batch_id=batch_id).agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.sum(F.when(passed, 1).otherwise(0)).alias("passed_checks"),
        F.sum(F.when(failed, 1).otherwise(0)).alias("failed_checks"),
        F.sum(F.when(passed.isNull(), 1).otherwise(0)).alias("unknown_checks"),
    )
    rate = F.lit(100.0).cast("decimal(4,1)") * F.col("passed_checks") / F.nullif(F.col("total_checks"), F.lit(0))
    return counts.withColumn("pass_rate_pct", F.round(rate, 2))


def alerts(results: DataFrame, as_of=None, minutes: int = 60, batch_id: str | None = None) -> DataFrame:
    """Failed checks of the window; unknown ones are not failures."""
    rows = recent(results, as_of, minutes=minutes, batch_id=batch_id).where(F.col("passed") == F.lit(False))
    return rows.select(
        "check_name", "check_type", "table_name", "result_value", "threshold_value", "error_message", "executed_at"
    ).orderBy("check_type", "table_name", "check_name")


def per_day(results: DataFrame, as_of=None, days: int = 7) -> DataFrame:
    rows = results.where(F.col("executed_at") > minus(as_of_column(as_of), days=days))
    passed = F.col("passed")
    return (
        rows.groupBy(F.to_date("executed_at").alias("check_date"))
        .agg(
            F.count(F.lit(1)).alias("total_checks"),
            F.sum(F.when(passed, 1).otherwise(0)).alias("passed"),
            F.sum(F.when(~passed, 1).otherwise(0)).alias("failed"),
        )
        .orderBy(F.desc("check_date"))
    )


def critical_failures(results: DataFrame) -> DataFrame:
    return results.where(F.col("check_name").isin(*CRITICAL_CHECKS) & (F.col("passed") == F.lit(False)))


# Messages quoted by the gate.
QUOTED = 100


class QualityGateError(Exception):
    """A critical check failed."""


def gate(results: DataFrame) -> None:
    """Raise when a critical check of these results failed; others only show in the reports.

    The message gives their exact number and quotes up to ``QUOTED`` of them; all are in the check results.
    """
    bad = critical_failures(results)
    n = bad.count()
    if n:
        said = [r.error_message for r in bad.select("error_message").orderBy("error_message").limit(QUOTED).collect()]
        more = f" and {n - len(said)} more in the check results" if n > len(said) else ""
        raise QualityGateError(f"{n} critical checks failed: {said}{more}")
