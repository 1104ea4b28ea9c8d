"""Shared column helpers of the text operators: word splitting, row keys, work tables, checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Everything in ASCII but digits and lower-case letters parts words.
WORD_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Sides up to this many rows of a few numbers or words each may be broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Lower-cased words of a text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAP, -1), "")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_key`` and ``text`` of documents; the first two name a document.

    Rows that repeat both id and text are one document, rows of one id with different texts are several.
    """
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """Write to the shared work folder and read back, which cuts lineage and outlives executors."""
    path = workspace(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if a count of the stored rows allows it, else left to a shuffle join."""
    return F.broadcast(df) if df.count() <= most else df


def same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns, for joins."""
    on = a[names[0]].eqNullSafe(b[names[0]])
    for name in names[1:]:
        on = on & a[name].eqNullSafe(b[name])
    return on
