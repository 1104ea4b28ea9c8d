"""Costly columns, worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df.withColumn`` for a costly value that later filters and columns use several times.

    Spark moves filters below projections by copying the expressions they test, so the value would be
    worked out again for every use. It does not move them below a generator, hence the explode of a
    one-element list, which costs next to nothing and keeps rows where they are. The value itself is made
    below it: a projection compiles it, while a generator would interpret it row by row.
    """
    others = [c for c in df.columns if c != name]
    made = df.select(*others, value.alias("__once"))
    out = made.select(*others, F.explode(F.array("__once")).alias(name))
    return out.select(*df.columns) if name in df.columns else out
