"""Stored cursor pages without numbers, put in order by following their cursors.

A page is a row ``(fetch_id, cursor, payload)``: the cursor it was asked for with, null for the first page of a fetch.
Its payload names the next one. Following them page by page would take as many steps as a fetch has pages; pointer
doubling takes the logarithm: round ``k`` knows the page ``2^k`` further on for every page, and the first ``2^k`` pages
of every fetch, from which it places the next ``2^k``. Only keys are joined, by fetch and cursor, so a fetch of any
length is spread over all tasks; payloads meet their number once, at the end.

A page that a chain meets again keeps its first place, so a loop ends there. Pages that no chain reaches, after a page
that is missing, have no place. Of several pages stored under one cursor the first by content counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions import variants as V
from millrace.session import workspace
from millrace.sources.pages import unnest_cursor

COMPLETE, GAP, LOOP, NO_START = "complete", "gap", "loop", "no first page"


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _name(cursor: Column) -> Column:
    """A page's name in its fetch; the first page has one that no cursor can have."""
    return F.when(cursor.isNull(), F.lit("first")).otherwise(F.concat(F.lit("at "), cursor))


def _nodes(pages: DataFrame, cursor: str) -> DataFrame:
    """``fetch_id, page, content, next`` of each stored page, one per name; ``stored`` counts what was there."""
    target = F.try_variant_get("payload", V.path("meta", "next_cursor"), "string")
    # Zero and false end a fetch as an absent cursor does.
    target = F.when(~target.isin("", "0", "false"), target)
    content = F.xxhash64(F.to_json("payload"))
    rows = pages.select("fetch_id", _name(F.col(cursor)).alias("page"), content.alias("content"), F.when(target.isNotNull(), _name(target)).alias("next"))
    return rows.groupBy("fetch_id", "page").agg(F.min(F.struct("content", "next")).alias("first"), F.count(F.lit(1)).alias("stored")).select(
        "fetch_id", "page", "first.content", "first.next", "stored"
    )


def _places(nodes: DataFrame) -> DataFrame:
    """``fetch_id, page, page_no`` of the pages that can be reached from a fetch's first page."""
    jumps = nodes.select("fetch_id", "page", F.col("next").alias("to"))
    pages = jumps.select("fetch_id", F.col("page").alias("to"))
    # A cursor without a stored page leads nowhere.
    jumps = _stored(jumps.where("to is not null").join(pages, ["fetch_id", "to"], "left_semi").select("fetch_id", "page", "to"), "jumps")
    placed = _stored(nodes.where("page = 'first'").select("fetch_id", "page", F.lit(0).cast("bigint").alias("page_no")), "placed")
    n, step = placed.count(), 1
    while True:
        far = placed.join(jumps, ["fetch_id", "page"]).select("fetch_id", F.col("to").alias("page"), (F.col("page_no") + step).alias("page_no"))
        # What a loop meets again keeps its first place.
        placed = _stored(placed.unionByName(far).groupBy("fetch_id", "page").agg(F.min("page_no").alias("page_no")), "placed")
        before, n = n, placed.count()
        if n == before:
            return placed
        onward = jumps.select("fetch_id", F.col("page").alias("to"), F.col("to").alias("onward"))
        jumps = _stored(jumps.join(onward, ["fetch_id", "to"]).select("fetch_id", "page", F.col("onward").alias("to")), "jumps")
        step *= 2


def linked_pages(pages: DataFrame, cursor: str = "cursor") -> DataFrame:
    """``fetch_id, page_no, payload`` of the pages that have a place, as `pages.unnest_cursor` takes them."""
    nodes = _stored(_nodes(pages, cursor), "pages")
    places = _places(nodes).join(nodes.select("fetch_id", "page", "content"), ["fetch_id", "page"])
    keyed = pages.select("fetch_id", _name(F.col(cursor)).alias("page"), F.xxhash64(F.to_json("payload")).alias("content"), "payload")
    one = keyed.join(places, ["fetch_id", "page", "content"])
    # Equal pages stored twice are one.
    return one.groupBy("fetch_id", "page_no").agg(F.first("payload").alias("payload"))


def unnest_linked(pages: DataFrame, items_key: str = "data", cursor: str = "cursor") -> DataFrame:
    """Records of linked cursor pages in their order."""
    return unnest_cursor(linked_pages(pages, cursor), items_key)


def link_report(pages: DataFrame, cursor: str = "cursor") -> DataFrame:
    """Per fetch: pages stored, different ones, placed and not, and how its chain ends."""
    nodes = _stored(_nodes(pages, cursor), "pages")
    placed = nodes.join(_places(nodes), ["fetch_id", "page"], "left")
    per_fetch = placed.groupBy("fetch_id").agg(
        F.sum("stored").alias("n_stored"),
        F.count(F.lit(1)).alias("n_pages"),
        F.count("page_no").alias("n_placed"),
        # The page the chain ends with is the one with the highest number.
        F.max(F.when(F.col("page_no").isNotNull(), F.struct("page_no", "next"))).alias("last"),
    )
    ends = per_fetch.select("fetch_id", F.col("last.next").alias("page"))
    there = ends.join(nodes.select("fetch_id", "page"), ["fetch_id", "page"], "left_semi").select("fetch_id", F.lit(True).alias("again"))
    state = (
        F.when(F.col("n_placed") == 0, NO_START).when(F.col("last.next").isNull(), COMPLETE).when(F.col("again"), LOOP).otherwise(GAP)
    )
    return per_fetch.join(there, "fetch_id", "left").select(
        "fetch_id", "n_stored", "n_pages", "n_placed", (F.col("n_pages") - F.col("n_placed")).alias("n_lost"), state.alias("state")
    )
