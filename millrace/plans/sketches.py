"""Distinct ids over any span of days, from mergeable sketches instead of rows.

A row per source, day and batch keeps a HyperLogLog sketch of the ids beside exact counts. Counts of rows add up, but
distinct ids of two days do not: their sketches do. A week or a year is then a union of a few small sketches, and a
new batch adds its own rows without a look at old ones. With ``LG_K`` 14 a sketch takes up to 16 KB and is off by 0.8 % or
less in two of three cases; up to some hundred ids it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LG_K = 14
SCHEMA = "source string, event_date date, batch_id string, row_count bigint, unique_ids bigint, ids binary"


def day_sketches(rows: DataFrame, source: str, key: str = "id", clock: str = "created_at", lg_k: int = LG_K) -> DataFrame:
    """Rows of `SCHEMA` for rows with ``batch_id``. Rows without a key count, but are no id."""
    groups = rows.groupBy(F.to_date(clock).alias("event_date"), "batch_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct(key).alias("unique_ids"), F.hll_sketch_agg(key, lg_k).alias("ids")
    )
    return groups.select(F.lit(source).alias("source"), "event_date", "batch_id", "row_count", "unique_ids", "ids")


def distinct_ids(sketches: DataFrame, *by: Column) -> DataFrame:
    """Per group of ``by``: rows exactly, and distinct ids as estimated from the union of the sketches."""
    grouped = sketches.groupBy(*by) if by else sketches.groupBy()
    return grouped.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("ids")), F.lit(0)).alias("unique_ids_estimate"),
        # No more than the ids of all parts, no fewer than those of the largest.
        F.max("unique_ids").alias("unique_ids_least"),
        F.sum("unique_ids").alias("unique_ids_most"),
    )


def weekly_ids(sketches: DataFrame) -> DataFrame:
    """Distinct ids per source and week, weeks named by their Monday."""
    return distinct_ids(sketches, F.col("source"), F.to_date(F.date_trunc("week", "event_date")).alias("week"))
