"""Masking, retention and schema drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.functions import variants as V
from millrace.functions.text import mask_email
from millrace.functions.timefn import as_of_column, minus
from millrace.operators.days import ingested

# Days that each layer is kept; None keeps for good.
RETENTION_DAYS: Mapping[str, int | None] = {"staging": 30, "raw": 90, "clean": None, "analytics": None}


def masked(df: DataFrame, columns: Sequence[str], role: str, masked_roles: tuple[str, ...] = ("ANALYST_ROLE",)) -> DataFrame:
    """The table as a role may see it."""
    return df.withColumns({c: mask_email(F.col(c), role, masked_roles) for c in columns})


def retained(df: DataFrame, layer: str, as_of=None, column: str = "ingested_at", days: int | None = None) -> DataFrame:
    """Rows still inside the layer's retention; the comparison reaches the scan."""
    keep = RETENTION_DAYS[layer] if days is None else days
    return df if keep is None else ingested(df, minus(as_of_column(as_of), days=keep), column=column)


def expired_days(staged: DataFrame, as_of=None, days: int | None = None) -> DataFrame:
    """``dt`` partitions of the staging area that are past retention; ``staged`` is best ``staged_days``."""
    keep = RETENTION_DAYS["staging"] if days is None else days
    limit = F.date_format(minus(as_of_column(as_of), days=keep), "yyyy-MM-dd")
    return staged.where(F.col("dt") < limit).select("source", "dt").distinct()


def schema_drift(raw: DataFrame, clean: DataFrame, as_of=None, days: int = 1) -> DataFrame:
    """Top-level payload keys seen lately, NEW when the clean table has no such column.

    Each task reduces its rows to distinct keys before the shuffle. The known columns are a
    constant list of the table's own schema, not a relation that grows.
    """
    recent = ingested(raw, minus(as_of_column(as_of), days=days), strict=True)
    keys = recent.select(F.explode(F.map_keys(F.try_variant_get(F.col("payload"), "$", V.ENTRIES))).alias("raw_field"))
    spark = raw.sparkSession
    known = spark.createDataFrame([(c.upper(),) for c in clean.columns], "column_name string")
    found = keys.distinct()
    joined = found.join(F.broadcast(known), F.upper("raw_field") == F.col("column_name"), "left")
    status = F.when(F.col("column_name").isNull(), "NEW").otherwise("EXISTS").alias("status")
    return joined.select("raw_field", status).orderBy(F.desc("status"), "raw_field")
