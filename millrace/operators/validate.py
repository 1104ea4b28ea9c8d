"""Required-field validation and the split into valid and rejected records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import variants as V
from millrace.functions.text import is_blank

ERRORS, INDEX = "_validation_errors", "_record_index"

# The error texts.
MISSING = "Missing required field: "
NULL = "Null value for required field: "
EMPTY = "Empty value for required field: "


NOT_OBJECT = "Record is not an object"


class ValidationError(Exception):
    def __init__(self, errors: list[str]):
        self.errors = errors
        super().__init__(f"Validation failed: {errors}")


def _payload_error(v: Column, name: str) -> Column:
    value = V.field(v, name)
    # A number, list or object never reads as blank text, so only texts can be empty.
    return (
        F.when(value.isNull(), F.lit(MISSING + name))
        .when(F.is_variant_null(value), F.lit(NULL + name))
        .when(is_blank(F.try_variant_get(value, "$", "string")), F.lit(EMPTY + name))
    )


def _column_error(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(MISSING + name)
    c = F.col(f"`{name}`")
    error = F.when(c.isNull(), F.lit(NULL + name))
    return error.when(is_blank(c), F.lit(EMPTY + name)) if isinstance(df.schema[name].dataType, T.StringType) else error


def with_validation_errors(df: DataFrame, required: Sequence[str], payload: str | None = None) -> DataFrame:
    """Add the list of errors, in field order.

    With ``payload`` the fields are looked up in that VARIANT column, where missing and null differ;
    otherwise they are columns, missing when there is no such column.
    """
    errors = [_payload_error(F.col(payload), f) if payload else _column_error(df, f) for f in required]
    if payload:
        other = F.try_variant_get(F.col(payload), "$", V.ENTRIES).isNull()
        errors = [F.when(other, F.lit(NOT_OBJECT)), *(F.when(~other, e) for e in errors)]
    listed = F.array_compact(F.array(*errors)) if errors else F.array().cast("array<string>")
    return df.withColumn(ERRORS, listed)


def split_valid(
    df: DataFrame,
    required: Sequence[str],
    payload: str | None = None,
    raise_on_error: bool = False,
    index: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected). Rejected rows keep their errors, and their position when ``index`` names it."""
    checked = with_validation_errors(df, required, payload)
    valid = checked.where(F.size(ERRORS) == 0).drop(ERRORS)
    rejected = checked.where(F.size(ERRORS) > 0)
    if raise_on_error:
        order = [F.col(index)] if index else []
        first = (rejected.orderBy(*order) if order else rejected).select(ERRORS).limit(1).collect()
        if first:
            raise ValidationError(list(first[0][ERRORS]))
    if index:
        rejected = rejected.withColumn(INDEX, F.col(index))
    return valid, rejected
