"""Upsert: matched and newer rows replace, unmatched rows are added, all other rows stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Unmatched NULL keys are spread over this many shuffle buckets instead of meeting in one task.
NULL_SPREAD = 4096


def _newer(s: Column, t: Column, version: str) -> Column:
    # A NULL version on either side makes this NULL, which keeps the target row.
    return s[version] > t[version]


def _spread(df: DataFrame, key: str) -> Column:
    """0 for real keys; for NULL keys, which match nothing, a bucket made from the row's content."""
    return F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(NULL_SPREAD))).otherwise(F.lit(0))


def merge_newer(target: DataFrame, source: DataFrame, key: str, version: str) -> DataFrame:
    """The target after the upsert, for a source of any size; one shuffle of both sides on the key.

    The source holds at most one row per key. A NULL key matches nothing, so a source row with a NULL
    key is always added.
    """
    columns = target.columns
    t = target.select(F.col(key).alias("__k"), _spread(target, key).alias("__b"), F.struct(*columns).alias("t"))
    s = source.select(F.col(key).alias("__k"), _spread(source, key).alias("__b"), F.struct(*columns).alias("s"))
    both = t.join(s, ["__k", "__b"], "full_outer")
    t, s = F.col("t"), F.col("s")
    merged = F.when(t.isNull() | _newer(s, t, version), s).otherwise(t)
    return both.select(merged.alias("m")).select("m.*")


def merge_newer_small(target: DataFrame, source: DataFrame, key: str, version: str) -> DataFrame:
    """The same upsert for a source known to be small: the target is not shuffled at all.

    Broadcasts the source, so the caller must have checked its size (see ``sinks.tables.upsert``). The
    second pass over the target reads its key column only.
    """
    columns = target.columns
    s = source.select(F.col(key).alias("__k"), F.struct(*columns).alias("s"))
    t = target.select(F.col(key).alias("__tk"), F.struct(*columns).alias("t"))
    kept = t.join(F.broadcast(s), F.col("__tk") == F.col("__k"), "left").select(
        F.when(_newer(F.col("s"), F.col("t"), version), F.col("s")).otherwise(F.col("t")).alias("m")
    )
    hits = target.select(F.col(key).alias("__k")).join(F.broadcast(s.select("__k")), "__k", "left_semi")
    added = s.join(hits, "__k", "left_anti").select(F.col("s").alias("m"))
    return kept.unionByName(added).select("m.*")
