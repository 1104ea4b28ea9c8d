"""Records out of stored API pages.

A page is a row ``(fetch_id, page_no, payload)``: the payload of the ``page_no``-th response, from 0, of one
fetch. Pages after the point where the fetch would have stopped are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions import variants as V

# Pages of one fetch are summed in blocks of this many before the blocks are added up, so that
# a fetch of any length never meets in one task.
PAGE_BLOCK = 4096


def _records(pages: DataFrame, items_key: str) -> DataFrame:
    items = V.items(V.field(F.col("payload"), items_key))
    return pages.select("fetch_id", "page_no", F.posexplode(items).alias("item_no", "record"))


def _until(pages: DataFrame, last: DataFrame) -> DataFrame:
    """Pages up to each fetch's last one; a fetch without a stop keeps all its pages."""
    joined = pages.join(last, "fetch_id", "left")
    return joined.where(F.col("last_page").isNull() | (F.col("page_no") <= F.col("last_page"))).drop("last_page")


def _first_stop(facts: DataFrame, stop: Column) -> DataFrame:
    # min over a condition combines map-side: one row per fetch and task is shuffled.
    return facts.where(stop).groupBy("fetch_id").agg(F.min("page_no").alias("last_page"))


def _item_count(items_key: str) -> Column:
    return F.coalesce(F.size(V.items(V.field(F.col("payload"), items_key))), F.lit(0))


def unnest_cursor(pages: DataFrame, items_key: str = "data") -> DataFrame:
    """Records of cursor pages: a fetch ends at an empty page or one without a next cursor."""
    cursor = F.try_variant_get(F.col("payload"), V.path("meta", "next_cursor"), "string")
    facts = pages.select("fetch_id", "page_no", _item_count(items_key).alias("n"), cursor.alias("cursor"))
    # Zero and false end a fetch as an absent cursor does.
    ended = F.col("cursor").isNull() | F.col("cursor").isin("", "0", "false")
    return _records(_until(pages, _first_stop(facts, (F.col("n") <= 0) | ended)), items_key)


def running_total(facts: DataFrame, value: str) -> DataFrame:
    """Add ``total_so_far`` per fetch in page order, without one task per fetch."""
    blocked = facts.withColumn("block", F.floor(F.col("page_no") / PAGE_BLOCK))
    per_block = blocked.groupBy("fetch_id", "block").agg(F.sum(value).alias("block_sum"))
    earlier = Window.partitionBy("fetch_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_block.select("fetch_id", "block", F.coalesce(F.sum("block_sum").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("fetch_id", "block").orderBy("page_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.join(starts, ["fetch_id", "block"])
        .withColumn("total_so_far", F.col("start") + F.sum(value).over(inside))
        .drop("block", "start")
    )


def unnest_offset(pages: DataFrame, items_key: str = "items") -> DataFrame:
    """Records of offset pages: a fetch ends at an empty page or once ``total`` records have come.

    A page without a total counts as total 0, so it ends the fetch.
    """
    total = F.coalesce(F.try_variant_get(F.col("payload"), V.path("total"), "bigint"), F.lit(0))
    facts = pages.select("fetch_id", "page_no", _item_count(items_key).alias("n"), total.alias("total"))
    ended = (F.col("n") <= 0) | (F.col("total_so_far") >= F.col("total"))
    return _records(_until(pages, _first_stop(running_total(facts, "n"), ended)), items_key)
