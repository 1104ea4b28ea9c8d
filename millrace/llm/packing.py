"""Shards by vector bin packing.

Groups of equal texts are measured in bytes, tokens and rows. Each group, largest first, goes to the shard where the
dot product of its vector and the residual capacity is highest. Large groups, of which there can only be so many, are
placed first against the whole capacity. The others are dealt out over blocks of bounded size that share what is left
of every shard, and blocks are packed side by side. A group stays in one shard unless it is above a quarter of a
shard's share of all bytes, tokens or rows; it is then split into pieces by document id. Rows of large groups meet
their shard by a broadcast, so that no group lands in one task.

Defined cases: a null text has size 1, no tokens and groups with other nulls, not with empty texts. Repeated rows are
rows of their own. Extra columns are ignored. Slots of a shard count its rows without gaps, in no set order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.ship import shipped
from millrace.llm.words import stored

SHARDS = 8
# A group with more than one part in so many of a shard's share of all bytes, tokens or rows is split.
SPLIT = 4
# A group with more than one part in so many of all is placed before the others. At most three times as many can be.
LARGE = 2048
BLOCK_GROUPS = 20_000
SLOT_ROWS = 20_000
DIMS = ("bytes", "tokens", "rows")


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, the group of a text, its size, tokens (white-space words) and checksum."""
    text = F.coalesce("text", F.lit(""))
    row = docs.select(
        "doc_id",
        F.sha2(F.encode(F.concat(F.when(F.col("text").isNull(), "0").otherwise("1"), text), "UTF-8"), 256).alias("group"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")).cast("bigint").alias("tokens"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    return row.select("doc_id", F.unhex("group").alias("group"), "size", "tokens", "text_crc32", F.xxhash64("doc_id").alias("spread"))


def _pack(total: np.ndarray, left: np.ndarray, share: np.ndarray):
    """Packer of a block: ``left`` is the capacity (shard, measure) for groups that sum up to ``share``, in parts of ``total``."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        v = pdf[list(DIMS)].to_numpy(float) / np.where(total > 0, total, 1)  # each measure counts alike
        order = np.lexsort((pdf["group"].to_numpy(), pdf["piece"].to_numpy(), -v.sum(1), -v.max(1)))
        room = left * (v.sum(0) / np.where(share > 0, share, 1))
        shards, shard = len(room), np.empty(len(v), np.int32)
        turn = int(pdf["block"].iloc[0])  # ties go round, so that blocks do not favour one shard
        for i in order:
            score = room @ v[i]
            s = int(np.argmax(np.roll(score, -(turn % shards))) + turn) % shards
            room[s] -= v[i]
            shard[i] = s
            turn += 1
        return pdf.assign(shard=shard)[["group", "piece", *DIMS, "shard"]]

    return run


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row; shards are near equal in bytes, tokens and rows."""
    shipped(docs.sparkSession)
    sums = (F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    schema = "group binary, piece int, bytes bigint, tokens bigint, rows bigint, shard int"
    rows = stored(measured(docs), "measured")
    groups = stored(rows.groupBy("group").agg(*sums), "groups")
    total = groups.agg(*(F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMS), F.count(F.lit(1)).alias("groups")).first()
    whole = np.array([total[d] for d in DIMS], float)

    parts = F.greatest(*(F.ceil(F.col(d) * SPLIT * shards / max(1, total[d])) for d in DIMS)).cast("int")
    is_large = F.greatest(*(F.col(d) * LARGE / max(1, total[d]) for d in DIMS)) > 1
    large = F.broadcast(stored(groups.where(is_large).select("group", parts.alias("parts")), "large"))
    of_large = rows.join(large, "group").withColumn("piece", F.pmod("spread", "parts").cast("int")).drop("parts")
    items = of_large.groupBy("group", "piece").agg(*sums).withColumn("block", F.lit(0))
    capacity = np.full((shards, len(DIMS)), 1 / shards)
    first = stored(items.groupBy("block").applyInPandas(_pack(whole, capacity, np.ones(len(DIMS))), schema), "placed")
    for r in first.groupBy("shard").agg(*(F.sum(d).alias(d) for d in DIMS)).collect():  # one row a shard
        capacity[r["shard"]] -= [r[d] / max(1, total[d]) for d in DIMS]

    blocks = max(1, -(-(total["groups"]) // BLOCK_GROUPS))
    items = groups.join(large, "group", "left_anti").withColumn("piece", F.lit(0))
    items = items.withColumn("block", F.pmod(F.xxhash64("group", "piece"), F.lit(blocks)).cast("int"))
    others = stored(items.groupBy("block").applyInPandas(_pack(whole, capacity, capacity.sum(0)), schema), "placed")

    of_large = of_large.join(F.broadcast(first.select("group", "piece", "shard")), ["group", "piece"])
    of_others = rows.join(large, "group", "left_anti").join(others.select("group", "shard"), "group")
    columns = ("doc_id", "size", "text_crc32", "spread", "shard")
    return _slotted(of_large.select(*columns).unionByName(of_others.select(*columns)), total["rows"])


def _slotted(rows: DataFrame, n: int) -> DataFrame:
    """Slots per shard: rows are counted within small cells, and the cells of a shard follow each other."""
    cells = max(1, -(-n // SLOT_ROWS))
    rows = stored(rows.withColumn("cell", F.pmod("spread", F.lit(cells)).cast("int")), "cells")
    counts = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select(F.col("shard").alias("s"), F.col("cell").alias("c"), F.coalesce(before, F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size"))
    numbered = rows.withColumn("nth", nth - 1)
    out = numbered.join(firsts, (F.col("shard") == F.col("s")) & (F.col("cell") == F.col("c")))
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("nth")).cast("bigint").alias("slot"))
