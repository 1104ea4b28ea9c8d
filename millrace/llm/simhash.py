"""SimHash near-duplicates by a byte-position inverted index.

A fingerprint has eight bytes. Two that differ in at most four bits share at least four bytes at their places, so
four is the guaranteed number of matches. The index lists every distinct fingerprint under each choice of four places
with their bytes, which are the shortest lists that no such pair can miss. Of two fingerprints that meet, the shared
positional bytes are tallied from their difference; the pair is kept at the first list of its shared bytes only, and
verified bit by bit. Copies share one fingerprint and enter the index once.

Defined cases: a null or empty text has no words and fingerprint zero, linked like any other. Repeated rows keep
their rows and share a component. A null id never names a component unless no other id is in it. Extra columns are
ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.chunks import holding, slices
from millrace.llm.components import connected
from millrace.llm.ship import shipped
from millrace.llm.words import fresh, same, stored

SHINGLE, SEED, BITS, BYTES = 4, 42, 4, 8
HASHES = 1 << 16  # hashes whose bits are counted at once


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit integer: bits set in over half of all shingle hashes."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i : i + n] for i in range(shingle)), strict=True)) if len(words) >= shingle else iter((b" ".join(words),))
    votes = np.zeros(64, np.int64)
    while block := list(itertools.islice(shingles, HASHES)):
        h = np.array([xxhash.xxh64_intdigest(s, seed) for s in block], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, keyed: bool = False) -> DataFrame:
    """``doc_id, fingerprint`` (signed) of each row; with ``keyed`` also ``text_key`` after the id."""
    shipped(docs.sparkSession)
    rows = docs.select("doc_id", *([F.xxhash64("text").alias("text_key")] if keyed else []), "text")
    names = rows.columns[:-1]
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding("simhash", lambda: None)
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([fingerprint(t, shingle, seed) for t in texts], pa.int64())], [*names, "fingerprint"])

    return rows.mapInArrow(run, f"{kinds}, fingerprint bigint")


def _postings(prints: DataFrame, need: int) -> DataFrame:
    """``list`` and fingerprint: a list is named by the mask of its places, then their bytes."""
    byte = [F.shiftrightunsigned("fingerprint", 8 * i).bitwiseAND(255) for i in range(BYTES)]
    lists = []
    for places in itertools.combinations(range(BYTES), need):
        name = F.lit(sum(1 << i for i in places)).cast("bigint")
        for i in places:
            name = F.shiftleft(name, 8).bitwiseOR(byte[i])
        lists.append(name)
    return prints.select("fingerprint", F.explode(F.array(*lists)).alias("list"))


def _shared(difference: Column) -> Column:
    """Mask of the bytes that are zero in a difference."""
    mask = F.lit(0)
    for i in range(BYTES):
        mask = mask + F.when(F.shiftrightunsigned(difference, 8 * i).bitwiseAND(255) == 0, 1 << i).otherwise(0)
    return mask


def near_pairs(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints at most ``bits`` bits apart, each once."""
    need = BYTES - bits
    if need < 1:
        raise ValueError("fingerprints that share no byte cannot be found by their bytes")
    index = _postings(prints, need)
    a, b = index.select("list", F.col("fingerprint").alias("a")), index.select("list", F.col("fingerprint").alias("b"))
    difference = F.col("a").bitwiseXOR(F.col("b"))
    shared = _shared(difference)
    mask = F.shiftright(a["list"], 8 * need)
    upto = mask.bitwiseOR(F.shiftright(mask, 1))
    upto = upto.bitwiseOR(F.shiftright(upto, 2))
    upto = upto.bitwiseOR(F.shiftright(upto, 4))
    first = shared.cast("bigint").bitwiseAND(upto) == mask
    met = (a["list"] == b["list"]) & (F.col("a") < F.col("b")) & (F.bit_count(difference) <= bits)
    # Spark sizes the index like the fingerprints it was exploded from, 70 times too low, and would broadcast it.
    return a.join(b.hint("merge"), met & (F.bit_count(shared) >= need) & first).select("a", "b")


def near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fingerprint, component_id`` (smallest id reachable over links) of each row."""
    prints = stored(fingerprints(docs, shingle, seed), "fingerprints")
    classes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    roots = connected(near_pairs(classes.select("fingerprint"), bits))
    linked = classes.join(roots.select(F.col("node").alias("fingerprint"), "root"), "fingerprint").groupBy("root").agg(F.min("first").alias("least"))
    ids = roots.join(linked, "root").select(F.col("node").alias("fingerprint"), "least")
    ids = classes.join(ids, "fingerprint", "left").select("fingerprint", F.coalesce("least", "first").alias("component_id"))
    return prints.hint("merge").join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """One row of ``docs`` of each component: the smallest id, null ids last, then one text, then one of repeated rows."""
    prints = stored(fingerprints(docs, shingle, seed, keyed=True), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = stored(prints.groupBy("fingerprint").agg(F.min(row).alias("first")), "classes")
    roots = connected(near_pairs(classes.select("fingerprint"), bits)).select(F.col("node").alias("fingerprint"), "root")
    heads = classes.join(roots, "fingerprint", "left").groupBy(F.coalesce("root", "fingerprint").alias("root")).agg(F.min("first").alias("head"))
    repeated = prints.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    heads = heads.select("head.doc_id", "head.text_key")
    again = stored(repeated.join(heads, same(repeated, heads, "doc_id", "text_key"), "left_semi"), "again")
    single = heads.join(again, same(heads, again, "doc_id", "text_key"), "left_anti")
    kept = lambda some: docs["doc_id"].eqNullSafe(some["doc_id"]) & (F.xxhash64(docs["text"]) == some["text_key"])
    once = docs.join(single, kept(single), "left_semi")
    if not again.limit(1).count():
        return once
    # Only rows that stand more than once are dealt by their key, the first per task at most.
    nth = F.row_number().over(Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64(*docs.columns)))
    name = fresh(docs, "nth")
    more = docs.join(again, kept(again), "left_semi").withColumn(name, nth).where(F.col(name) == 1).drop(name)
    return once.unionByName(more)
