"""Normalise records: key names, timestamps and surrounding whitespace, at any depth."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.functions import timefn, variants as V
from millrace.functions.sqltext import any_of, let, literal, name
from millrace.functions.text import snake_key, snake_name, snake_sql, trim_sql

TOO_DEEP = "payload is nested deeper than max_depth; raise max_depth"


def container_sql(
    value: str, depth: int, timestamps: Sequence[str] = (), normalize_keys: bool = True, split_acronyms: bool = False, to_utc: bool = False
) -> str:
    """SQL text of a normalised object or list; the elements of a list carry a NULL key."""
    c, p = f"c{depth}", f"p{depth}"
    renamed = snake_sql("e.key", split_acronyms) if normalize_keys else "e.key"
    listed = f"transform({V.items_sql(value)}, x -> struct(CAST(NULL AS STRING) AS key, x AS value))"
    children = (
        f"transform(coalesce({V.entries_sql(value)}, {listed}), e -> struct("
        f"e.key AS key, {renamed} AS name, e.value AS value, schema_of_variant(e.value) AS kind))"
    )
    deeper = f"CAST(raise_error({literal(TOO_DEEP)}) AS VARIANT)"
    if depth > 1:
        deeper = container_sql(f"{c}.value", depth - 1, timestamps, normalize_keys, split_acronyms, to_utc)
    stamp = ""
    if timestamps:
        stamped = timefn.normalize_ts_variant(f"{c}.value", f"{c}.kind", to_utc=to_utc)
        is_stamp = f"{any_of(f'{c}.key', timestamps)} OR {any_of(f'{c}.name', timestamps)}"
        stamp = f"WHEN {is_stamp} THEN CAST({stamped} AS VARIANT)"
    text = trim_sql(f"try_variant_get({c}.value, '$', 'string')")
    named = f"{c}.key IS NOT NULL"
    done = (
        f"CASE {stamp} WHEN {named} AND {V.is_text(f'{c}.kind')} THEN CAST({text} AS VARIANT)"
        f" WHEN {V.is_object(f'{c}.kind')} OR ({named} AND {V.is_array(f'{c}.kind')}) THEN {deeper}"
        f" ELSE {c}.value END"
    )
    finished = f"transform({children}, {c} -> struct({c}.name AS key, {done} AS value))"
    # An empty list has no element to tell it from an object by.
    is_list = f"get({p}, 0).key IS NULL AND {V.items_sql(value)} IS NOT NULL"
    as_list = f"to_variant_object(transform({p}, x -> x.value))"
    as_object = f"to_variant_object(map_from_entries(filter({p}, x -> x.key != '')))"
    return let(p, finished, f"IF({is_list}, {as_list}, {as_object})")


def normalize_variant(
    column: str,
    timestamps: Sequence[str] = (),
    normalize_keys: bool = True,
    split_acronyms: bool = False,
    to_utc: bool = False,
    max_depth: int = 8,
) -> Column:
    """Normalise the objects of a VARIANT column whose keys are not known.

    Objects in objects and in lists are followed; texts directly inside a list are left alone. A
    payload deeper than ``max_depth`` raises rather than passing half done. A key left empty by the
    clean-up is dropped, and of colliding keys the last in key order wins.
    """
    source = name(column)
    is_object = V.is_object(f"schema_of_variant({source})")
    done = container_sql(source, max_depth, timestamps, normalize_keys, split_acronyms, to_utc)
    return F.expr(f"IF({is_object}, {done}, NULL)")


def depth_of(column: str) -> Column:
    """Levels of objects and lists in a VARIANT value."""
    bare = F.regexp_replace(F.to_json(column), r'"(?:[^"\\]++|\\.)*+"', "")
    brackets = F.split(F.translate(F.regexp_replace(bare, r"[^\[\]{}]", ""), "[]{}", "<><>"), "")
    return F.aggregate(
        brackets,
        F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")),
        lambda a, b: F.struct(
            (a["now"] + F.when(b == "<", 1).when(b == ">", -1).otherwise(0)).alias("now"),
            F.greatest(a["most"], a["now"] + F.when(b == "<", 1).otherwise(0)).alias("most"),
        ),
        lambda a: a["most"],
    )


def variant_depth(df: DataFrame, column: str) -> int:
    """Levels of objects and lists in the deepest payload of a VARIANT column."""
    return df.agg(F.max(depth_of(column)).alias("most")).first()["most"] or 0


def key_report(df: DataFrame, column: str = "payload", split_acronyms: bool = False) -> DataFrame:
    """Top-level keys that collide or vanish under `snake_key`.

    One row per resulting name: how many spellings lead to it, two of them, and in how many places.
    """
    keys = df.select(F.explode(F.map_keys(F.try_variant_get(F.col(column), "$", V.ENTRIES))).alias("raw_key"))
    per_key = keys.groupBy("raw_key").agg(F.count(F.lit(1)).alias("occurrences"))
    grouped = (
        per_key.withColumn("name", snake_key("raw_key", split_acronyms))
        .groupBy("name")
        .agg(
            F.count(F.lit(1)).alias("spellings"),
            F.min("raw_key").alias("first_spelling"),
            F.max("raw_key").alias("last_spelling"),
            F.sum("occurrences").alias("occurrences"),
        )
    )
    return grouped.where((F.col("spellings") > 1) | (F.col("name") == ""))


def normalize_struct(
    df: DataFrame,
    timestamps: Sequence[str] = (),
    normalize_keys: bool = True,
    split_acronyms: bool = False,
    to_utc: bool = False,
) -> DataFrame:
    """Normalise typed, possibly nested columns: a projection worked out from the schema."""

    fresh = itertools.count()

    def rename(field: str) -> str:
        return snake_name(field, split_acronyms) if normalize_keys else field

    def value(x: str, dtype: T.DataType, field: str) -> str:
        if field in timestamps or rename(field) in timestamps:
            return timefn.normalize_ts_sql(x, dtype.simpleString(), to_utc=to_utc)
        if isinstance(dtype, T.StringType):
            return trim_sql(x)
        if isinstance(dtype, T.StructType):
            return f"IF({x} IS NOT NULL, struct({', '.join(columns(dtype, x))}), NULL)"
        if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType):
            # Inner lists see this variable too, so each level has its own.
            var = f"x{next(fresh)}"
            return f"transform({x}, {var} -> {value(var, dtype.elementType, '')})"
        return x

    def columns(schema: T.StructType, parent: str | None) -> list[str]:
        out: dict[str, str] = {}
        for f in schema.fields:
            new = rename(f.name)
            if not new:
                continue
            x = name(f.name) if parent is None else f"{parent}.{name(f.name)}"
            out.pop(new, None)
            out[new] = f"{value(x, f.dataType, f.name)} AS {name(new)}"
        return list(out.values())

    return df.selectExpr(*columns(df.schema, None))
