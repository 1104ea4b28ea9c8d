"""Removal of repeated passages by hashing lines and sentences.

A text is parted after line breaks and sentence ends. Units are normalised (A-Z in lower case, white space to single
blanks) and hashed where the document is read; only keys, offsets and digests move. Digests are grouped globally with
partial minima per task, and the earliest ranked place of each is kept. Units that stand elsewhere before are joined
into runs of neighbours; a run of ``least_words`` words or more is cut out, shorter ones are everyday phrases and stay.
So passages are found that begin or end inside a line, and runs of short lines, which no single line would show.

A digest that makes up more than one in ``HOT`` of all units is sent to all tasks, as there are fewer than ``HOT`` of
these; the others are joined by a shuffle that has no large group.

Defined cases: a null or empty text has no units and stays. Rank is the document id, then a hash of its text, then the
offset; a null id ranks first. Rows that repeat id and text are one document: they are cut alike. Different texts under
one id are documents of their own. Other columns pass through; one named ``removed`` is replaced.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from millrace.llm.chunks import slices
from millrace.llm.ship import shipped
from millrace.llm.words import bounded, keyed, same, stored

LEAST_WORDS = 20
HOT = 10_000
# Parts that make up the whole text: a line or sentence with what ends it, or a paragraph.
ENDS = "\n.!?。！？"
UNITS = {
    "sentence": re.compile(rf"[^{ENDS}]*[{ENDS}]+[ \t\r\n\f\v]*|[^{ENDS}]+"),
    "line": re.compile(r"[^\n]*\n+|[^\n]+"),
    "paragraph": re.compile(r"(?:[^\n]|\n(?![ \t\r]*\n))+(?:\n\s*)?|\n\s*"),
}
PLACE = "start bigint, stop bigint, words bigint, nth bigint, digest binary"
SPAN = "array<struct<start:bigint,stop:bigint,kept_doc_id:{0},kept_start:bigint>>"


def units(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """``doc_id, text_key, start, stop, words, nth, digest`` of each unit with a word, ``nth`` counting them.

    Offsets are code points, end exclusive.
    """
    shipped(docs.sparkSession)
    rows, part = keyed(docs).select("doc_id", "text_key", F.col("text").cast("string").alias("text")), UNITS[unit]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            at: list[int] = []
            places: list[tuple[int, int, int, int]] = []
            digests: list[bytes] = []
            for i, raw in enumerate(texts):
                start = nth = 0
                for piece in part.findall(raw.decode()):
                    stop = start + len(piece)
                    words = piece.encode().lower().split()
                    if words:
                        at.append(i)
                        places.append((start, stop, len(words), nth))
                        digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                        nth += 1
                    start = stop
            rows = pa.array(at, pa.int64())
            numbers = np.array(places, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), *(pa.array(c) for c in numbers), pa.array(digests, pa.binary())],
                ["doc_id", "text_key", "start", "stop", "words", "nth", "digest"],
            )

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text_key bigint, {PLACE}")


def repeated_units(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """Units that stand at an earlier ranked place too, with that place: ``kept_doc_id, kept_start``."""
    found = stored(units(docs, unit), "units", compression="zstd")
    place = F.struct("doc_id", "text_key", "start")
    kept = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("kept")).where("n > 1")
    kept = stored(kept, "kept", compression="zstd")
    total = found.count()
    # The counts of hot digests add up to no more than the total, so there are fewer than HOT of them.
    hot = kept.where(F.col("n") * HOT > total).select("digest", F.col("kept").alias("hot"))
    met = found.join(F.broadcast(hot), "digest", "left")
    rare = kept.where(F.col("n") * HOT <= total).select("digest", "kept")
    others = met.where("hot is null").drop("hot").join(rare, "digest")
    both = met.where("hot is not null").withColumnRenamed("hot", "kept").unionByName(others)
    return both.where(~place.eqNullSafe(F.col("kept"))).select(
        "doc_id", "text_key", "nth", "start", "stop", "words", F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start")
    )


def repeated_spans(docs: DataFrame, unit: str = "sentence", least_words: int = LEAST_WORDS) -> DataFrame:
    """Runs to cut out per document: ``doc_id, text_key, start, stop, kept_doc_id, kept_start``.

    The kept place is that of the first unit of the run.
    """
    found = repeated_units(docs, unit).distinct()
    # Neighbours have the same difference between their number and their rank.
    order = Window.partitionBy("doc_id", "text_key").orderBy("nth")
    runs = found.withColumn("run", F.col("nth") - F.row_number().over(order)).groupBy("doc_id", "text_key", "run")
    first = F.min(F.struct("start", "kept_doc_id", "kept_start"))
    spans = runs.agg(first.alias("first"), F.max("stop").alias("stop"), F.sum("words").alias("words")).where(F.col("words") >= least_words)
    return spans.select("doc_id", "text_key", "first.start", "stop", "first.kept_doc_id", "first.kept_start")


def remove_repeats(docs: DataFrame, unit: str = "sentence", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with repeated runs cut out of ``text``; ``removed`` has their offsets in the text as it was and the
    places that were kept."""
    span = F.struct("start", "stop", "kept_doc_id", "kept_start")
    spans = repeated_spans(docs, unit, least_words).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    spans = bounded(stored(spans, "spans"))
    whole = docs.select(F.struct(*docs.columns).alias("doc"), "doc_id", F.xxhash64("text").alias("text_key"))
    none = F.array().cast(SPAN.format(docs.schema["doc_id"].dataType.simpleString()))
    both = whole.join(spans, same(whole, spans, "doc_id", "text_key"), "left").select("doc", F.coalesce("spans", none).alias("spans"))
    # What is kept lies between the end of one removed run and the start of the next.
    froms = F.concat(F.array(F.lit(0).cast("bigint")), F.col("spans.stop"))
    tos = F.concat(F.col("spans.start"), F.array(F.length("doc.text").cast("bigint")))
    cut = F.array_join(F.zip_with(froms, tos, lambda a, b: F.substring(F.col("doc.text"), (a + 1).cast("int"), (b - a).cast("int"))), "")
    text = F.when(F.size("spans") > 0, cut).otherwise(F.col("doc.text")).alias("text")
    columns = [text if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns if c != "removed"]
    return both.select(*columns, F.col("spans").alias("removed"))
