"""Bounds on the ingest time that reach the day folders of RAW."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INGEST_DAY = "ingest_day"  # folder of RAW


def ingested(df: DataFrame, bound: Column, strict: bool = False, column: str = "ingested_at") -> DataFrame:
    """Rows ingested at or after a time (only after it if ``strict``).

    Where the table has its day folders as a column, no older folder is opened, also when the bound is a scalar
    subquery and known only at run time.
    """
    late = F.col(column) > bound if strict else F.col(column) >= bound
    if INGEST_DAY in df.columns and column == "ingested_at":
        late = (F.col(INGEST_DAY) >= F.to_date(bound)) & late
    return df.where(late)
