"""Incremental extraction: only what changed since the previous run."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.timefn import as_of_column


def changed_since(df: DataFrame, column: str, since=None, inclusive: bool = False) -> DataFrame:
    """Rows whose clock is after ``since``; all rows when there is no previous run.

    Whether a remote service counts the boundary itself is its own choice, hence ``inclusive``.
    """
    if since is None:
        return df
    start = as_of_column(since)
    return df.where(F.col(column) >= start if inclusive else F.col(column) > start)
