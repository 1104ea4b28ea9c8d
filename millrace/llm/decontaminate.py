"""Benchmark decontamination over a positional inverted index.

The index holds one posting (document, position, term) for each training word that is a benchmark word, written where
the document was read: postings of a document stay together, so that building needs no shuffle. A search counts the
postings of each term, takes the rarest terms of every benchmark window as anchors and intersects their postings
after subtracting the place of the term in its item. What is left are diagonals (document, item, first word of the
item in the document), and the postings along these are read to give the exact runs.

Defined cases: a null or empty text has no words, and no window occurs in it; an empty benchmark hits nothing. Rows
that repeat an id and text are one document. A null item id counts as the empty string. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.words import bounded, keyed, same, stored, words

DOC = ("doc_id", "text_key")
# The mark behind the last word of a document: its position is the number of words.
END = -1


class Items:
    """Benchmark items as (item, item_id, size) and (item, place, term), with the terms as (term, word)."""

    def __init__(self, benchmark: DataFrame):
        rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w"))
        rows = rows.where(F.size("w") > 0).distinct().select(F.monotonically_increasing_id().alias("item"), "item_id", "w")
        rows = stored(rows, "items")
        terms = rows.select(F.explode("w").alias("word")).distinct().select(F.monotonically_increasing_id().alias("term"), "word")
        self.terms = stored(terms, "terms")
        self.names = rows.select("item", "item_id", F.size("w").cast("bigint").alias("size"))
        places = rows.select("item", F.size("w").cast("bigint").alias("size"), F.posexplode("w").alias("place", "word"))
        places = places.join(bounded(self.terms), "word").select("item", "size", F.col("place").cast("bigint").alias("place"), "term")
        self.places = stored(places, "places")


def build_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the given terms, and an end mark for each document."""
    end = terms.sparkSession.range(1).select(F.lit(END).cast("bigint").alias("term"), F.lit("").alias("word"))
    tokens = keyed(docs).select(*DOC, F.posexplode(F.concat(words(F.col("text")), F.array(F.lit("")))).alias("pos", "word"))
    postings = tokens.join(bounded(terms.unionByName(end)), "word").select(*DOC, F.col("pos").cast("bigint").alias("pos"), "term")
    return stored(postings, "postings", compression="zstd")


def _ranked(index: DataFrame, needles: DataFrame, *by: str) -> DataFrame:
    """Terms with their number of postings, ranked from the rarest; a needle with a term that never occurs goes."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("postings"))
    rare = needles.join(counts, "term", "left")
    w = Window.partitionBy(*by)
    rare = rare.withColumn("least", F.min(F.coalesce("postings", F.lit(0))).over(w)).where("least > 0")
    return rare.withColumn("rank", F.row_number().over(w.orderBy("postings", "place")))


def _of_documents(index: DataFrame, docs: DataFrame) -> DataFrame:
    """Postings of some documents."""
    docs = bounded(stored(docs.select(*DOC).distinct(), "found"))
    return index.join(docs, same(index, docs, *DOC), "left_semi")


def phrase_matches(index: DataFrame, items: Items, window: int = 13, anchors: int = 3) -> DataFrame:
    """Longest runs of an item's words in a document: ``doc_id, text_key, item, place, start, length``.

    A run has at least ``window`` words, or the whole item if that is shorter. ``place`` is its first word in the
    item, ``start`` in the document.
    """
    need = F.least(F.lit(window), F.col("size"))
    starts = F.explode(F.sequence(F.greatest(F.lit(0), F.col("place") - need + 1), F.least(F.col("place"), F.col("size") - need)))
    windows = items.places.select("item", "size", "place", "term", starts.alias("first"))
    rare = _ranked(index, windows, "item", "first").where(F.col("rank") <= anchors)
    rare = rare.select("item", "first", "place", "term", F.col("rank").cast("int").alias("rank"), F.least(need, F.lit(anchors)).cast("int").alias("need"))
    rare = bounded(stored(rare, "anchors"))
    met = index.join(rare, "term").select(*DOC, "item", "first", (F.col("pos") - F.col("place")).alias("at"), "need", F.expr("shiftleft(1, rank - 1)").alias("bit"))
    met = met.groupBy(*DOC, "item", "first", "at", "need").agg(F.bit_or("bit").alias("bits"))
    lines = stored(met.where(F.expr("bits = shiftleft(1, need) - 1")).select(*DOC, "item", "at").distinct(), "diagonals")

    probes = lines.join(bounded(items.places), "item").select(*DOC, "item", "size", "at", "place", "term", (F.col("at") + F.col("place")).alias("pos"))
    own = _of_documents(index, lines)
    on = same(probes, own, *DOC) & (probes["pos"] == own["pos"]) & (probes["term"] == own["term"])
    hits = probes.join(own, on, "left_semi").select(*DOC, "item", "size", "at", "place")
    nth = F.row_number().over(Window.partitionBy(*DOC, "item", "at").orderBy("place"))
    runs = hits.withColumn("run", F.col("place") - nth).groupBy(*DOC, "item", "size", "at", "run").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("length"))
    return runs.where(F.col("length") >= need).select(*DOC, "item", "place", (F.col("at") + F.col("place")).alias("start"), "length")


def proximity_matches(index: DataFrame, items: Items, slop: int) -> DataFrame:
    """Places of an item's rarest word with all the item's words at most ``slop`` words off: ``doc_id, text_key, item, pos``."""
    terms = items.places.groupBy("item", "term").agg(F.min("place").alias("place"))
    ranked = stored(_ranked(index, terms, "item"), "near")
    rare, sizes = bounded(ranked.where("rank = 1").select("item", "term")), ranked.groupBy("item").agg(F.max("rank").alias("size"))
    seen = stored(index.join(rare, "term").select(*DOC, "item", "pos"), "seen")
    around = seen.select(*DOC, "item", F.col("pos").alias("centre"), F.explode(F.sequence(F.col("pos") - slop, F.col("pos") + slop)).alias("pos"))
    own = _of_documents(index, seen)
    near = around.join(own, same(around, own, *DOC) & (around["pos"] == own["pos"])).select(*(around[c] for c in DOC), "item", "centre", "term")
    near = near.join(ranked.select("item", "term"), ["item", "term"], "left_semi")
    full = near.groupBy(*DOC, "item", "centre").agg(F.count_distinct("term").alias("n")).join(sizes, "item")
    return full.where("n = size").select(*DOC, "item", F.col("centre").alias("pos"))


def _covered(spans: DataFrame) -> DataFrame:
    """Words inside at least one span, per document."""
    order = Window.partitionBy(*DOC).orderBy("start", "length")
    before = F.max(F.col("start") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("length") - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    return spans.select(*DOC, fresh.alias("fresh")).groupBy(*DOC).agg(F.sum("fresh").alias("n_hit"))


def joined_ids(ids: Column) -> Column:
    return F.array_join(F.array_sort(F.collect_set(ids)), ",")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20) -> DataFrame:
    """Per document: words, words inside benchmark windows, items met, and whether ``one_in * n_hit >= n_words``.

    Columns: ``doc_id, text_key, n_words, n_hit, n_items, items, contaminated``; ``items`` are ids in text order,
    comma-joined.
    """
    items = Items(benchmark)
    index = build_index(docs, items.terms)
    spans = stored(phrase_matches(index, items, window), "spans")
    named = spans.join(bounded(items.names.select("item", "item_id")), "item")
    found = named.groupBy(*DOC).agg(F.count_distinct("item_id").alias("n_items"), joined_ids(F.col("item_id")).alias("items"))
    hit = _covered(spans.select(*DOC, "start", "length").distinct())
    found = found.join(hit, same(found, hit, *DOC)).select(*(found[c] for c in DOC), "n_items", "items", "n_hit")
    sizes = index.where(F.col("term") == END).groupBy(*DOC).agg(F.max("pos").alias("n_words"))
    out = sizes.join(found, same(sizes, found, *DOC), "left").select(
        *(sizes[c] for c in DOC),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
    )
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20) -> DataFrame:
    """Rows of ``docs`` that are not contaminated."""
    bad = decontaminate(docs, benchmark, window, one_in).where("contaminated").select(*DOC)
    on = docs["doc_id"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["text"]) == bad["text_key"])
    return docs.join(bad, on, "left_anti")
