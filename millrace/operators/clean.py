"""RAW to CLEAN: typed projection of the payload, newest row per key, incremental slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import variants as V
from millrace.functions.timefn import NTZ, as_of_column
from millrace.operators.days import ingested
from millrace.operators.dedupe import latest_per_key
from millrace.specs import LINEAGE, SourceSpec

CAST_ERRORS = "_cast_errors"

# Fixed value: where an incremental run starts when the clean table is empty.
BEGINNING = "1900-01-01"
# RAW rows have no ordinal, so versions that tie are told apart by their file and content.
CONTENT = "_content"
STABLE_ORDER = ("file_name", CONTENT)


def project(raw: DataFrame, spec: SourceSpec, as_of=None, on_error: str = "fail", extra: Sequence[str] = ()) -> DataFrame:
    """Typed columns of the payload, lineage columns and the load time.

    A value that does not fit its type raises with ``on_error="fail"`` and is NULL with ``"null"``.
    """
    payload = F.col("payload")
    typed = [V.field(payload, f.keys, f.dtype, on_error).alias(f.name) for f in spec.fields]
    return raw.select(*typed, *LINEAGE, as_of_column(as_of).alias("_loaded_at"), *extra)


def with_cast_errors(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add the names of fields whose value is there but does not fit its type."""
    payload = F.col("payload")

    def misfit(f) -> Column:
        there = V.field(payload, f.keys)
        bad = there.isNotNull() & ~F.is_variant_null(there) & V.field(payload, f.keys, f.dtype, "null").isNull()
        return F.when(bad, F.lit(f.name))

    return raw.withColumn(CAST_ERRORS, F.array_compact(F.array(*[misfit(f) for f in spec.fields])))


def split_castable(raw: DataFrame, spec: SourceSpec) -> tuple[DataFrame, DataFrame]:
    """(rows whose fields all fit, rows to set aside with the names of the fields that do not)."""
    checked = with_cast_errors(raw, spec)
    return checked.where(F.size(CAST_ERRORS) == 0).drop(CAST_ERRORS), checked.where(F.size(CAST_ERRORS) > 0)


def clean_full(
    raw: DataFrame, spec: SourceSpec, as_of=None, on_error: str = "fail", tie_break: Sequence[str] = ()
) -> DataFrame:
    """The clean table, rebuilt from all of RAW."""
    if CONTENT in tie_break and CONTENT not in raw.columns:
        raw = raw.withColumn(CONTENT, F.xxhash64(F.to_json("payload")))
    typed = project(raw, spec, as_of, on_error, [t for t in tie_break if t in raw.columns and t not in LINEAGE])
    return latest_per_key(typed, spec.key, spec.version, tie_break).select(*spec.clean_columns)


def incremental_slice(
    raw: DataFrame, clean: DataFrame, spec: SourceSpec, as_of=None, on_error: str = "fail", tie_break: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key among the RAW rows ingested after the clean table's last load.

    The last load is a scalar subquery, so Spark works it out first and pushes the comparison into
    the RAW scan, and into its day folders where RAW comes with them.
    """
    last_load = clean.agg(F.coalesce(F.max("_loaded_at"), F.lit(BEGINNING).cast(NTZ)).alias("t")).scalar()
    return clean_full(ingested(raw, last_load, strict=True), spec, as_of, on_error, tie_break)
