"""Flatten nested records: typed structs by projection, VARIANT payloads by expression."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import variants as V
from millrace.functions.sqltext import let, literal, name
from millrace.operators.once import computed_once


def flatten_variant(column: str, sep: str = "_", max_depth: int = 10) -> Column:
    """Flat objects of the nested ones in a VARIANT column whose keys are not known.

    Lists stay whole, empty objects vanish, objects below ``max_depth`` levels stay objects. When two
    paths give one name the last in key order wins.
    """

    def level(value: str, prefix: str | None, depth: int) -> str:
        e, n = f"e{depth}", f"n{depth}"
        joined = f"IF({prefix} = '', {e}.key, concat({prefix}, {literal(sep)}, {e}.key))" if prefix else f"{e}.key"
        leaf = f"array(struct({n} AS key, {e}.value AS value))"
        # The inner list is NULL for all but objects.
        pairs = f"coalesce({level(f'{e}.value', n, depth - 1)}, {leaf})" if depth else leaf
        return f"flatten(transform({V.entries_sql(value)}, {e} -> {let(n, joined, pairs)}))"

    return F.expr(f"to_variant_object(map_from_entries({level(name(column), None, max_depth)}))")


def flatten_struct(df: DataFrame, sep: str = "_", max_depth: int = 10) -> DataFrame:
    """Flat columns of nested struct columns: a plain projection, free at any scale.

    When two paths give one name the last column wins.
    """
    flat: dict[str, Column] = {}

    def walk(schema: T.StructType, parent: Column | None, prefix: str, depth: int) -> None:
        for f in schema.fields:
            path = f"{prefix}{sep}{f.name}" if prefix else f.name
            c = parent.getField(f.name) if parent is not None else F.col(f"`{f.name}`")
            if isinstance(f.dataType, T.StructType) and depth > 0:
                walk(f.dataType, c, path, depth - 1)
            else:
                flat.pop(path, None)
                flat[path] = c

    # The top level does not count as a descent.
    walk(df.schema, None, "", max_depth)
    return df.select([c.alias(path) for path, c in flat.items()])


# Type names of a schema text; quoted field names are matched whole and plain ones are followed by a colon.
TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)|\bVOID\b(?!\s*:)")
TYPE_NAMES = {"OBJECT": "STRUCT", "VOID": "VARIANT"}


def struct_ddl(schema: str | None) -> str:
    """The type text of a merged schema; a field with mixed types stays VARIANT."""
    return TYPE_WORD.sub(lambda m: TYPE_NAMES.get(m[0], m[0]), schema) if schema else "STRUCT<>"


def struct_type_of(df: DataFrame, column: str) -> str:
    """The struct type that covers every payload of a VARIANT column, found in one aggregation pass.

    The pass is a map-side merge of schemas; only the merged text comes to the driver. A field with
    mixed types stays VARIANT.
    """
    return struct_ddl(df.agg(F.schema_of_variant_agg(column).alias("s")).first()["s"])


def type_payload(df: DataFrame, column: str, struct_ddl: str | None = None) -> DataFrame:
    """Replace a VARIANT column by typed columns, so that later steps are plain projections.

    A typed column can not tell a missing field from a null one: validate before typing.
    """
    ddl = struct_ddl or struct_type_of(df, column)
    typed = df.withColumn(column, F.try_variant_get(F.col(column), "$", ddl))
    return typed.select(*[c for c in df.columns if c != column], f"{column}.*")


def flatten_records(df: DataFrame, column: str = "payload", sep: str = "_", max_depth: int = 10) -> DataFrame:
    """Flatten the payload of every record; a payload that is not an object raises."""
    v = F.col(column)
    bad = v.isNotNull() & V.entries(v).isNull()
    message = F.concat(F.lit("record is not an object: "), F.to_json(v))
    flat = flatten_variant(column, sep, max_depth)
    return computed_once(df, column, F.when(bad, F.raise_error(message).cast("variant")).otherwise(flat))
