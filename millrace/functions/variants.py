"""Access to VARIANT payloads.

A VARIANT can not be grouped, sorted or compared, so keys are always taken out first.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ENTRIES, ITEMS = "map<string,variant>", "array<variant>"


def path(*keys: str) -> str:
    """JSON path to a nested field; keys may hold any character but a double quote."""
    return "$" + "".join(f'["{k}"]' for k in keys)


def field(v: Column, keys: str | tuple[str, ...], dtype: str = "variant", on_error: str = "fail") -> Column:
    """A field cast to ``dtype``; a value that does not fit raises, or is NULL with ``on_error="null"``."""
    keys = (keys,) if isinstance(keys, str) else keys
    get = F.variant_get if on_error == "fail" else F.try_variant_get
    return get(v, path(*keys), dtype)


def is_text(kind: str) -> str:
    """SQL text testing the SQL text of a ``schema_of_variant`` result, as do the next three.

    ``schema_of_variant`` walks the value, so work it out once per value.
    """
    return f"({kind} = 'STRING')"


def is_number(kind: str) -> str:
    return f"({kind} IN ('BIGINT', 'DOUBLE', 'FLOAT') OR {kind} LIKE 'DECIMAL%')"


def is_object(kind: str) -> str:
    return f"({kind} LIKE 'OBJECT%')"


def is_array(kind: str) -> str:
    return f"({kind} LIKE 'ARRAY%')"


def entries_sql(v: str) -> str:
    """`entries` over SQL text."""
    return f"map_entries(try_variant_get({v}, '$', '{ENTRIES}'))"


def items_sql(v: str) -> str:
    """`items` over SQL text."""
    return f"try_variant_get({v}, '$', '{ITEMS}')"


def entries(v: Column) -> Column:
    """(key, value) pairs of an object; NULL for anything else."""
    return F.map_entries(F.try_variant_get(v, "$", ENTRIES))


def items(v: Column) -> Column:
    """Elements of an array; NULL for anything else."""
    return F.try_variant_get(v, "$", ITEMS)


def is_missing(v: Column, key: str) -> Column:
    return F.variant_get(v, path(key), "variant").isNull()


def is_json_null(v: Column, key: str) -> Column:
    return F.is_variant_null(F.variant_get(v, path(key), "variant"))
