"""The analytics views over the clean tables.

Every view takes the two clean DataFrames it reads. ``ids_unique`` may be set for tables this package built:
they hold each non-NULL id once, so a distinct count is a plain count and needs no shuffle of the ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.timefn import as_of_column, boundary_diff, minus
from millrace.specs import API_A, API_B, SourceSpec

# Hours after which data is late, then stale.
WARNING_HOURS, STALE_HOURS = 6, 24


def _distinct_ids(ids_unique: bool) -> Column:
    return F.count("id") if ids_unique else F.count_distinct("id")


def _share(part: Column, total: Column) -> Column:
    return F.round(F.lit(100.0).cast("decimal(4,1)") * part / total, 2)


def _tagged(a: DataFrame, b: DataFrame, per_source) -> DataFrame:
    """The union of one aggregate per source, labelled with the source's name."""
    parts = [
        per_source(df, spec).withColumn("source", F.lit(spec.name)) for df, spec in ((a, API_A), (b, API_B))
    ]
    return parts[0].unionByName(parts[1])


def daily_event_counts(a: DataFrame, b: DataFrame, ids_unique: bool = False, ordered: bool = True) -> DataFrame:
    def per_source(df: DataFrame, _spec: SourceSpec) -> DataFrame:
        return df.groupBy(F.to_date("created_at").alias("event_date")).agg(
            F.count(F.lit(1)).alias("event_count"), _distinct_ids(ids_unique).alias("unique_records")
        )

    out = _tagged(a, b, per_source).select("source", "event_date", "event_count", "unique_records")
    return out.orderBy(F.desc_nulls_first("event_date"), "source") if ordered else out


def daily_summary(a: DataFrame, b: DataFrame, as_of=None, ids_unique: bool = False) -> DataFrame:
    """Content of the materialised summary table."""
    return daily_event_counts(a, b, ids_unique, ordered=False).withColumn("_refreshed_at", as_of_column(as_of))


def summary_of_days(days_a: DataFrame, days_b: DataFrame, as_of=None) -> DataFrame:
    """The same table from the states of the clean tables' buckets (`sinks.buckets.day_states`)."""

    def per_source(days: DataFrame, _spec: SourceSpec) -> DataFrame:
        return days.groupBy("event_date").agg(F.sum("event_count").alias("event_count"), F.sum("unique_records").alias("unique_records"))

    out = _tagged(days_a, days_b, per_source).select("source", "event_date", "event_count", "unique_records")
    return out.withColumn("_refreshed_at", as_of_column(as_of))


def freshness_status(latest: Column, now: Column) -> Column:
    """HEALTHY also when there is no data: an unknown age is not above a limit."""
    age = boundary_diff("HOUR", latest, now)
    return F.when(age > STALE_HOURS, "STALE").when(age > WARNING_HOURS, "WARNING").otherwise("HEALTHY")


def _freshness_facts(version: str, now: Column) -> list[Column]:
    lag = boundary_diff("MINUTE", F.col(version), F.col("ingested_at"))
    return [
        F.max(version).alias("latest_event_time"),
        F.max("ingested_at").alias("latest_ingestion_time"),
        F.max("_loaded_at").alias("latest_load_time"),
        F.avg(lag).alias("avg_ingestion_lag_minutes"),
        F.max(lag).alias("max_ingestion_lag_minutes"),
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.to_date("ingested_at") == F.to_date(now)).alias("records_today"),
    ]


def _ages(now: Column) -> dict[str, Column]:
    return {
        "event_age_minutes": boundary_diff("MINUTE", F.col("latest_event_time"), now),
        "ingestion_age_minutes": boundary_diff("MINUTE", F.col("latest_ingestion_time"), now),
        "freshness_status": freshness_status(F.col("latest_ingestion_time"), now),
    }


def data_freshness(a: DataFrame, b: DataFrame, as_of=None) -> DataFrame:
    now = as_of_column(as_of)
    facts = _tagged(a, b, lambda df, spec: df.agg(*_freshness_facts(spec.version, now)))
    return facts.withColumns(_ages(now)).select(
        "source",
        "latest_event_time",
        "latest_ingestion_time",
        "latest_load_time",
        "event_age_minutes",
        "ingestion_age_minutes",
        "avg_ingestion_lag_minutes",
        "max_ingestion_lag_minutes",
        "total_records",
        "records_today",
        "freshness_status",
    )


def ingestion_history(a: DataFrame, b: DataFrame, ids_unique: bool = False) -> DataFrame:
    """Per batch: first and last ingestion, rows, ids, and the first of its file names.

    A minimum over texts makes Spark sort its input, so it is taken over the few distinct files of a
    batch and never over the rows. When ids are unique the files carry all other facts too; otherwise
    these come from a hash aggregate of their own.
    """

    def facts(ids: Column) -> list[Column]:
        return [
            F.min("ingested_at").alias("batch_start"),
            F.max("ingested_at").alias("batch_end"),
            F.count(F.lit(1)).alias("record_count"),
            ids.alias("unique_ids"),
        ]

    def by_file(df: DataFrame, _spec: SourceSpec) -> DataFrame:
        return df.groupBy("batch_id", "file_name").agg(*facts(F.count("id"))).groupBy("batch_id").agg(
            F.min("batch_start").alias("batch_start"),
            F.max("batch_end").alias("batch_end"),
            F.sum("record_count").alias("record_count"),
            F.sum("unique_ids").alias("unique_ids"),
            F.min("file_name").alias("file_name"),
        )

    def by_row(df: DataFrame, _spec: SourceSpec) -> DataFrame:
        files = df.select("batch_id", "file_name").distinct().groupBy(F.col("batch_id").alias("file_batch"))
        named = files.agg(F.min("file_name").alias("file_name"))
        batches = df.groupBy("batch_id").agg(*facts(F.count_distinct("id")))
        return batches.join(named, F.col("batch_id").eqNullSafe(F.col("file_batch"))).drop("file_batch")

    columns = ["source", "batch_id", "batch_start", "batch_end", "record_count", "unique_ids", "file_name"]
    rows = _tagged(a, b, by_file if ids_unique else by_row).select(*columns)
    return rows.orderBy(F.desc_nulls_first("batch_start"), "source", "batch_id")


def top_categories(a: DataFrame, ids_unique: bool = False) -> DataFrame:
    """Counts and shares per category. The total is a scalar subquery over one column, so the groups
    never gather in one task as with a window over all of them."""
    known = a.where(F.col("category").isNotNull())
    total = known.agg(F.count(F.lit(1)).alias("n")).scalar()
    groups = known.groupBy("category").agg(
        F.count(F.lit(1)).alias("event_count"),
        _distinct_ids(ids_unique).alias("unique_records"),
        F.min("created_at").alias("first_seen"),
        F.max("updated_at").alias("last_updated"),
    )
    return groups.withColumn("pct_of_total", _share(F.col("event_count"), total)).orderBy(
        F.desc("event_count"), "category"
    )


def top_k_categories(a: DataFrame, k: int = 10) -> DataFrame:
    """The k largest categories; sort and limit become one bounded top-k step."""
    return top_categories(a).limit(k)


def status_distribution(a: DataFrame) -> DataFrame:
    """Counts and shares per status. The total is summed from the same groups, whose shuffle Spark uses twice."""
    groups = a.groupBy("status").agg(F.count(F.lit(1)).alias("count"))
    total = groups.agg(F.sum("count").alias("n")).scalar()
    return groups.withColumn("percentage", _share(F.col("count"), total)).orderBy(
        F.desc("count"), F.asc_nulls_last("status")
    )


def priority_distribution(b: DataFrame) -> DataFrame:
    groups = b.groupBy("priority", "state").agg(
        F.count(F.lit(1)).alias("count"), F.sum("amount").alias("total_amount"), F.avg("amount").alias("avg_amount")
    )
    return groups.orderBy(F.asc_nulls_last("priority"), F.asc_nulls_last("state"))


def hourly_activity(a: DataFrame, b: DataFrame) -> DataFrame:
    rows = _tagged(a.select("created_at"), b.select("created_at"), lambda df, _spec: df)
    groups = rows.groupBy(
        "source", F.hour("created_at").alias("hour_of_day"), F.dayname("created_at").alias("day_of_week")
    ).agg(F.count(F.lit(1)).alias("event_count"))
    return groups.orderBy("source", F.asc_nulls_last("hour_of_day"), F.asc_nulls_last("day_of_week"))


def _week_start(now: Column) -> Column:
    return F.date_sub(F.to_date(now), 7)


def dashboard_of(freshness: DataFrame, daily: DataFrame, as_of=None) -> DataFrame:
    """The dashboard from the freshness view and daily counts, which may be the materialised summary.

    Both sides have one row per source after the aggregate, so Spark broadcasts on their known size.
    """
    week = (
        daily.where(F.col("event_date") >= _week_start(as_of_column(as_of)))
        .groupBy("source")
        .agg(F.sum("event_count").alias("events_last_7_days"))
    )
    return freshness.join(week, "source", "left").select(
        "source",
        "total_records",
        "records_today",
        "freshness_status",
        "event_age_minutes",
        "avg_ingestion_lag_minutes",
        "events_last_7_days",
    )


def executive_dashboard(a: DataFrame, b: DataFrame, as_of=None) -> DataFrame:
    """The same dashboard in one pass over each clean table, without join or shuffle of rows.

    The week's daily counts add up to a conditional count of rows; no recent row means NULL, as a left
    join would give.
    """
    now = as_of_column(as_of)
    recent = F.nullif(F.count_if(F.to_date("created_at") >= _week_start(now)), F.lit(0)).alias("events_last_7_days")
    facts = _tagged(a, b, lambda df, spec: df.agg(*_freshness_facts(spec.version, now), recent))
    return facts.withColumns(_ages(now)).select(
        "source",
        "total_records",
        "records_today",
        "freshness_status",
        "event_age_minutes",
        "avg_ingestion_lag_minutes",
        "events_last_7_days",
    )


def clean_stats(a: DataFrame, b: DataFrame) -> DataFrame:
    def per_source(df: DataFrame, spec: SourceSpec) -> DataFrame:
        facts = df.agg(F.count(F.lit(1)).alias("total_rows"), F.max("_loaded_at").alias("last_load"))
        return facts.withColumn("table_name", F.lit(spec.table))

    return _tagged(a, b, per_source).select("table_name", "total_rows", "last_load")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def repeated_keys(df: DataFrame, key: str = "id") -> DataFrame:
    """Keys that occur more than once; NULL counts as one key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt")).where(F.col("cnt") > 1)


def duplicate_counts(tables: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """How many keys repeat, per named check."""
    repeated = table_counts({name: repeated_keys(df, key) for name, df in tables.items()})
    return repeated.select(F.col("table_name").alias("check_name"), F.col("row_count").alias("duplicate_count"))


def null_key_rows(df: DataFrame, key: str = "id") -> DataFrame:
    return df.where(F.col(key).isNull())


def recent_updates(df: DataFrame, version: str = "updated_at", as_of=None, days: int = 1) -> DataFrame:
    since = minus(as_of_column(as_of), days=days)
    return df.where(F.col(version) > since).orderBy(F.desc_nulls_first(version), F.asc_nulls_last("id"))


def volume_trend(daily: DataFrame, as_of=None, days: int = 7, inclusive: bool = False) -> DataFrame:
    """Daily counts of the last days; ``inclusive`` keeps the boundary day too."""
    start = F.date_sub(F.to_date(as_of_column(as_of)), days)
    day = F.col("event_date")
    return daily.where(day >= start if inclusive else day > start).orderBy(F.desc_nulls_first("event_date"), "source")


def register_views(a: DataFrame, b: DataFrame, as_of=None, ids_unique: bool = False) -> list[str]:
    """Publish all views for SQL users; returns their names."""
    views = {
        "vw_daily_event_counts": daily_event_counts(a, b, ids_unique),
        "vw_data_freshness": data_freshness(a, b, as_of),
        "vw_ingestion_history": ingestion_history(a, b, ids_unique),
        "vw_top_categories": top_categories(a, ids_unique),
        "vw_status_distribution": status_distribution(a),
        "vw_priority_distribution": priority_distribution(b),
        "vw_hourly_activity": hourly_activity(a, b),
        "vw_executive_dashboard": executive_dashboard(a, b, as_of),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
