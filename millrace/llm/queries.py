"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.llm import bpe, chat, decontaminate, fertility, licenses, packing, phrases, pii, repeats, simhash, token_counts, turn_trie, wavelet
from millrace.session import workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query
def op1_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", sha256(F.col("items")).alias("items_sha256"), "contaminated")


@query
def op2_fertility(spark, sf_dir):
    q = F.col("quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_tokens", "n_byte_tokens", "entropy")
    return fertility.measured(table(spark, sf_dir, "documents"), PIECES).select("doc_id", *(q[n].alias(n) for n in names))


@query
def op3_line_repeats(spark, sf_dir):
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    span = F.transform("removed", lambda r: F.concat_ws(":", *(r[c].cast("string") for c in ("start", "stop", "kept_doc_id", "kept_start"))))
    return cut.select("doc_id", "text", F.size("removed").cast("bigint").alias("n_removed"), F.array_join(span, ",").alias("removed"))


@query
def op4_pii(spark, sf_dir):
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    counts = [count(k.name) for k in pii.BASE]
    base = sha256(pii.span_text(F.col("spans"), base_only=True))
    return found.select("doc_id", *counts, base.alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans"))


@query
def op5_wavelet_shards(spark, sf_dir):
    folder = workspace(spark, "shards")
    wavelet.write_shards(table(spark, sf_dir, "documents"), WORD_BPE, folder)
    return wavelet.crc32_of(wavelet.read_documents(wavelet.read_shards(spark, folder)))


@query
def op6_bpe(spark, sf_dir):
    return bpe.digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), WORD_BPE), WORD_BPE))


@query
def op7_licenses(spark, sf_dir):
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.drop("text_key")


@query
def op8_chat(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    folder = workspace(spark, "chats")
    chat.format_paths(chat.chains(rows.unionByName(more))).write.parquet(folder)
    back = spark.read.parquet(folder)
    turns = chat.read_turns(F.col("formatted"))
    text = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.read_loss(F.col("formatted"), F.col("loss"))
    return back.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("bigint").alias("n_turns"),
        sha256(text).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        sha256(loss).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op9_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op10_packing(spark, sf_dir):
    packed = packing.shard(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op11_turn_trie(spark, sf_dir):
    return turn_trie.conversation_trie(table(spark, sf_dir, "conversations"))


@query
def op12_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)
