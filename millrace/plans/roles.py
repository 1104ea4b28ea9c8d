"""Masking for SQL users: the role is a session variable, the rule a SQL function, the table a view.

`register_masking` declares the variable ``reader_role`` and the function ``mask_for_reader``. A view made by
`masked_view` is kept as SQL text over the stored files, so that it follows the role at the time it is read, and no view of the
unmasked rows is left in the session. A session that has set no role is masked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from millrace.functions.sqltext import literal, name
from millrace.functions.text import MASK_PATTERN, MASK_TEXT

ROLE, FUNCTION = "reader_role", "mask_for_reader"


def register_masking(spark: SparkSession, masked_roles: Sequence[str] = ("ANALYST_ROLE",)) -> None:
    """Declare the role variable, unset, and the masking function of this session."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT NULL")
    roles = ", ".join(literal(r) for r in masked_roles)
    hidden = f"session.{ROLE} IS NULL OR session.{ROLE} IN ({roles})" if masked_roles else f"session.{ROLE} IS NULL"
    rule = f"CASE WHEN {hidden} THEN regexp_replace(v, {literal(MASK_PATTERN)}, {literal(MASK_TEXT)}) ELSE v END"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {FUNCTION}(v STRING) RETURNS STRING RETURN {rule}")


def set_role(spark: SparkSession, role: str | None) -> None:
    spark.sql(f"SET VAR {ROLE} = {'NULL' if role is None else literal(role)}")


def masked_view(spark: SparkSession, view: str, path: str, columns: Sequence[str], masked: Sequence[str]) -> None:
    """A view of a Parquet table with these columns, of which ``masked`` go through the rule."""
    unknown = set(masked) - set(columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    shown = ", ".join(f"{FUNCTION}({name(c)}) AS {name(c)}" if c in masked else name(c) for c in columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name(view)} AS SELECT {shown} FROM parquet.{name(path)}")
