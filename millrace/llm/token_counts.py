"""Token counts without token ids, for byte-level BPE vocabularies.

Such a vocabulary parts a text into pre-tokens and merges inside each of them only, so a text has as many tokens as its
pre-tokens have together. A first pass gathers the distinct pre-tokens of the whole table; each is put to the tokenizers
library once, which gives its number of pieces. A second pass makes the pre-token frequencies of each document, joins
the sizes to them and sums. No ids of documents are made.

Pre-tokens follow Zipf's law: " the" is in most documents. A pre-token that makes up more than one in ``HOT`` of all
occurrences is hot. There are fewer than ``HOT`` of them, of at most ``LONG`` bytes each, so their sizes are sent to all
tasks and joined where the document is read. No other pre-token has more than that share, so the frequencies of the
rest are joined by a shuffle that has no large group. Pre-tokens of ``LONG`` bytes or more are named by their SHA-512.

Defined cases: a null or empty text has no bytes and no tokens. Rows are counted one by one, so repeated rows and null
ids keep their row each. Strings of special tokens inside a text are one token each, as the library has it by default.
Only ``doc_id`` and ``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import slices
from millrace.llm.ship import shipped
from millrace.llm.words import stored

LIMIT = 512
HOT = 400_000
# Bytes from which a pre-token is named by a digest of as many bytes.
LONG = 64

# White space, letters and numbers below U+0250, as the vocabulary's rule parts them.
SPACE = "\t-\r \x85\xa0"
LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
PRE_TOKEN = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
BEYOND = re.compile("[^\x00-ɏ]")


class ByteLevel:
    """A vocabulary file of the tokenizers library without normaliser, parted by its byte-level rule."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        rule, added = spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"]) for t in added)
        if spec["normalizer"] or rule.get("type") != "ByteLevel" or rule["add_prefix_space"] or not rule["use_regex"] or not plain:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        # Longer strings first, as one may begin another.
        special = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special tokens stand between them."""
        if self.special is None or not self.special.search(text):
            return self._parted(text), 0
        parts = self.special.split(text)
        return [t for part in parts for t in self._parted(part)], len(parts) - 1

    def _parted(self, text: str) -> list[str]:
        if not BEYOND.search(text):
            return PRE_TOKEN.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def sizes(self, pre_tokens: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(pre_tokens, add_special_tokens=False)]


@functools.lru_cache(maxsize=2)
def _vocabulary(path: str) -> ByteLevel:
    return ByteLevel(path)


class _Parted:
    """Distinct pre-tokens of some texts with their names in joins, and where they stand."""

    def __init__(self, known: ByteLevel, texts: list[bytes]):
        parted = [known.pre_tokens(t.decode()) for t in texts]
        coded = pa.array([t for tokens, _ in parted for t in tokens], pa.string()).dictionary_encode()
        self.words = coded.dictionary.cast(pa.binary()).to_pylist()
        self.keys = [hashlib.sha512(w).digest() if len(w) >= LONG else w for w in self.words]
        self.codes = coded.indices.to_numpy()
        self.of = np.repeat(np.arange(len(texts)), [len(tokens) for tokens, _ in parted])
        self.special = np.array([n for _, n in parted], np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    shipped(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def pre_token_sizes(docs: DataFrame, path: str) -> DataFrame:
    """``key, n, n_tokens``: every distinct pre-token, how often it stands, and its number of tokens."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches):
            found = _Parted(_vocabulary(path), texts)
            long = [w.decode() if len(w) >= LONG else None for w in found.words]
            n = np.bincount(found.codes, minlength=len(found.words))
            yield pa.RecordBatch.from_arrays([pa.array(found.keys, pa.binary()), pa.array(long, pa.string()), pa.array(n, pa.int64())], ["key", "long", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            n = _vocabulary(path).sizes([t.decode() for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["key", "n", "n_tokens"])

    found = _rows(docs).select("text").mapInArrow(gather, "key binary, long string, n bigint").groupBy("key", "long").agg(F.sum("n").alias("n"))
    return found.select("key", "n", F.coalesce("long", F.col("key").cast("string")).alias("text")).mapInArrow(count, "key binary, n bigint, n_tokens bigint")


def frequencies(docs: DataFrame, path: str, hot: dict[bytes, int]) -> DataFrame:
    """``doc_id, n_bytes, tokens, pieces`` of each document row.

    ``tokens`` is the number of tokens of pre-tokens in ``hot`` and of special strings; ``pieces`` holds ``key`` and
    ``n`` of the document's other pre-tokens.
    """
    rows, sent = _rows(docs), docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sizes = _vocabulary(path), sent.value
        for batch, texts in slices(batches):
            found = _Parted(known, texts)
            size = np.fromiter((sizes.get(k, -1) for k in found.keys), np.int64, len(found.keys))
            here = size[found.codes]
            tokens = found.special + np.bincount(found.of, np.maximum(here, 0), len(texts)).astype(np.int64)
            rest, width = here < 0, max(1, len(found.words))
            pairs, n = np.unique(found.of[rest] * width + found.codes[rest], return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * width).astype(np.int32)
            keys = pa.array(found.keys, pa.binary()).take(pa.array(pairs % width))
            pieces = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([keys, pa.array(n, pa.int64())], ["key", "n"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(map(len, texts)), pa.int64()), pa.array(tokens), pieces], ["doc_id", "n_bytes", "tokens", "pieces"])

    kind = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes bigint, tokens bigint, pieces array<struct<key:binary,n:bigint>>"
    return rows.mapInArrow(run, kind).withColumn("row", F.monotonically_increasing_id())


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of each document row. ``path`` names the vocabulary on the executors."""
    sizes = stored(pre_token_sizes(docs, path), "sizes", compression="zstd")
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Fewer than ``hot`` rows, as each makes up more than one in ``hot`` of the total.
    often = {bytes(r.key): r.n_tokens for r in sizes.where(F.col("n") * hot > total).select("key", "n_tokens").toLocalIterator()}
    found = stored(frequencies(docs, path, often), "pieces", compression="zstd")
    rare = sizes.where(F.col("n") * hot <= total).select("key", "n_tokens")
    far = found.select("row", F.inline("pieces")).join(rare, "key").groupBy("row").agg(F.sum(F.col("n") * F.col("n_tokens")).alias("far"))
    both = found.select("row", "doc_id", "n_bytes", "tokens").join(far, "row", "left")
    counted = both.select("doc_id", "n_bytes", (F.col("tokens") + F.coalesce("far", F.lit(0))).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
