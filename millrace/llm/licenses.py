"""License scan by diagonal voting.

Every k-gram of a document's words is joined to the places where a template has it. A match votes for the diagonal
(place in the document minus place in the template). Phrases need all their votes on one diagonal. Of license texts,
neighbouring diagonals are merged, so that inserted or dropped words do not part a match, and a span counts if its
distinct template places cover enough of the template.

Defined cases: a null or empty text has no words, labels or places. Rows that repeat an id and text are one
document. Words are compared themselves, not only their hashes. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm.words import keyed, same, stored, words

K = 2
DOC = ("doc_id", "text_key")
END = "\n"

# Phrases that name a license, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Passages of license texts, with their labels.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc", "licensed under cc by nc 4 0"),
    ("cc", "this work is licensed under a creative commons attribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def template_grams(spark: SparkSession, phrases=PHRASES, templates=TEMPLATES, k: int = K) -> DataFrame:
    """``template, label, exact, grams, place, gram, hash`` for each k-gram of each template."""
    texts = [(label, True, text) for text, label in phrases] + [(label, False, text) for label, text in templates]
    rows = []
    for n, (label, exact, text) in enumerate(texts):
        w = text.split()
        grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)]
        if not grams:
            raise ValueError(f"a template has fewer than {k} words: {text!r}")
        rows += [(n, label, exact, len(grams), i, g) for i, g in enumerate(grams)]
    rows.append((-1, "", True, 1, 0, END))
    df = spark.createDataFrame(rows, "template int, label string, exact boolean, grams int, place int, gram string")
    return df.withColumn("hash", F.xxhash64("gram"))


def votes(docs: DataFrame, templates: DataFrame, k: int = K) -> DataFrame:
    """Matches of document k-grams and template places, with an end mark (template -1) for each document."""
    w = keyed(docs).select(*DOC, words(F.col("text")).alias("w"))
    at = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda i: (i >= 0) & (i + k <= F.size("w")))
    gram = F.transform(at, lambda i: F.concat_ws(" ", *(F.get("w", i + j) for j in range(k))))
    grams = w.select(*DOC, F.size("w").alias("n_words"), F.posexplode(F.concat(gram, F.array(F.lit(END)))).alias("pos", "gram"))
    grams = grams.withColumn("hash", F.xxhash64("gram"))
    t = F.broadcast(templates)  # as large as the template texts that the caller gave
    return grams.join(t, (grams["hash"] == t["hash"]) & (grams["gram"] == t["gram"])).select(*DOC, "n_words", "pos", "template", "label", "exact", "grams", "place")


def license_spans(met: DataFrame, k: int = K, drift: int = 4, cover: float = 0.6) -> DataFrame:
    """``doc_id, text_key, label, exact, start, words, score`` of verified spans."""
    met = met.where("template >= 0").withColumn("at", F.col("pos") - F.col("place"))
    key = (*DOC, "template", "label", "exact", "grams")
    lines = met.groupBy(*key, "at").agg(F.collect_set("place").alias("places"), F.min("pos").alias("start"), F.max("pos").alias("last"))
    full = lines.where("exact and size(places) = grams").select(*DOC, "label", "exact", "start", (F.col("last") + k).alias("stop"), F.lit(1.0).alias("score"))

    order = Window.partitionBy(*DOC, "template").orderBy("at")
    new = F.coalesce((F.col("at") - F.lag("at").over(order) > drift).cast("int"), F.lit(0))
    bands = lines.where("not exact").withColumn("new", new).withColumn("band", F.sum("new").over(order))
    bands = bands.groupBy(*key, "band").agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"), F.min("start").alias("start"), F.max("last").alias("last"))
    share = F.size("places") / F.col("grams")
    # A true copy is not much longer than its template; words strewn over a long text are no copy.
    compact = F.col("last") - F.col("start") <= 2 * F.col("grams")
    near = bands.where((share >= cover) & compact).select(*DOC, "label", "exact", "start", (F.col("last") + k).alias("stop"), share.alias("score"))
    return full.unionByName(near)


def scan_licenses(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES, k: int = K, drift: int = 4, cover: float = 0.6) -> DataFrame:
    """Per document: words, phrase places, their first and last, labels of phrases, all labels, best score."""
    # One pass over the texts; what is stored are the votes and one end mark per document.
    met = stored(votes(docs, template_grams(docs.sparkSession, phrases, templates, k), k), "votes")
    sizes = F.max("n_words").cast("bigint").alias("n_words")
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    spans = license_spans(met, k, drift, cover)
    per = spans.groupBy(*DOC).agg(
        F.count_if("exact").alias("n_base"),
        F.min(F.when(F.col("exact"), F.col("start"))).cast("bigint").alias("first_word"),
        F.max(F.when(F.col("exact"), F.col("start"))).cast("bigint").alias("last_word"),
        labels(F.collect_set(F.when(F.col("exact"), F.col("label")))).alias("base_labels"),
        labels(F.collect_set("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    docs = met.where("template = -1").groupBy(*DOC).agg(sizes)
    return docs.join(per, same(docs, per, *DOC), "left").select(
        docs["doc_id"],
        docs["text_key"],
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
