"""Token ids in wavelet matrices, one compressed file of planes per shard.

Documents are dealt out by ranges of their id, encoded, and gathered into shards of whole documents in ascending id
order. A shard keeps its ids as a wavelet matrix: bit-planes from the highest bit down, each in the stable order of
the bits above it, with counts of ones every 512 bits. Token access, counting and occurrence lookup read the planes
only. Shards are rows of a Parquet folder, so Spark writes and commits them on any store, and a task that is run
again after a lost executor replaces its files.

Defined cases: a null or empty text has just the end id. Repeated rows are documents of their own; equal ids follow
each other in text order. A document larger than a shard makes a shard of its own. A null id comes first.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.llm.bpe import byte_letters
from millrace.llm.chunks import CACHE_BYTES, gathered, joined, parted, slices
from millrace.llm.ship import shipped
from millrace.llm.words import bounded

END_ID = 2
SHARD_TOKENS = 1 << 20
RANGE_CHARS = 32  # of a text, which part rows of one id among tasks
BLOCK = 512  # bits between counts of ones
SCHEMA = "part int, seq int, doc_ids array<bigint>, lengths array<bigint>, n_tokens bigint, planes binary"


class WaveletMatrix:
    """Ids with access, rank and select over bit-planes."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], counts: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.counts = n, zeros, planes, counts

    @classmethod
    def build(cls, ids: np.ndarray, bits: int | None = None) -> WaveletMatrix:
        bits = bits or max(1, int(ids.max()).bit_length() if len(ids) else 1)
        now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        zeros, planes, counts = [], [], []
        for b in range(bits - 1, -1, -1):
            ones = (now & (1 << b)) != 0
            plane = np.packbits(ones, bitorder="little")
            planes.append(plane)
            counts.append(cls._counts(plane))
            # Places are much faster than masks, as bits come in no order.
            low = now.take(np.flatnonzero(~ones))
            zeros.append(len(low))
            now = np.concatenate((low, now.take(np.flatnonzero(ones))))
        return cls(len(ids), zeros, planes, counts)

    @staticmethod
    def _counts(plane: np.ndarray) -> np.ndarray:
        """Ones before each block."""
        step = BLOCK // 8
        ones = np.bitwise_count(np.pad(plane, (0, -len(plane) % step))).reshape(-1, step).sum(1, dtype=np.uint32)
        return np.concatenate((np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)))

    def to_bytes(self) -> bytes:
        head = struct.pack("<QB", self.n, len(self.planes)) + struct.pack(f"<{len(self.zeros)}Q", *self.zeros)
        body = b"".join(x.tobytes() for pair in zip(self.planes, self.counts, strict=True) for x in pair)
        return head + zstandard.compress(body, 1)

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        n, bits = struct.unpack_from("<QB", data)
        zeros = list(struct.unpack_from(f"<{bits}Q", data, 9))
        body, at, planes, counts = zstandard.decompress(data[9 + 8 * bits :]), 0, [], []
        size = -(-n // 8)
        blocks = -(-size // (BLOCK // 8)) + 1
        for _ in range(bits):
            planes.append(np.frombuffer(body, np.uint8, size, at))
            counts.append(np.frombuffer(body, "<u4", blocks, at + size))
            at += size + 4 * blocks
        return cls(n, zeros, planes, counts)

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block, plane = i // BLOCK, self.planes[level]
        start = block * BLOCK // 8
        count = int(self.counts[level][block]) + int(np.bitwise_count(plane[start : i // 8]).sum())
        return count + (int(plane[i // 8]) & (1 << i % 8) - 1).bit_count() if i % 8 else count

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = self.planes[level][i // 8] >> i % 8 & 1
            ones = self._ones(level, i)
            i = zeros + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, symbol: int, i: int) -> tuple[int, int]:
        """The stretch below the last plane that holds ``symbol`` of the first ``i`` places."""
        if symbol >> len(self.planes):
            return 0, 0
        start, stop = 0, i
        for level, zeros in enumerate(self.zeros):
            a, b = self._ones(level, start), self._ones(level, stop)
            start, stop = (zeros + a, zeros + b) if symbol >> len(self.planes) - 1 - level & 1 else (start - a, stop - b)
        return start, stop

    def rank(self, symbol: int, i: int) -> int:
        """How often ``symbol`` stands among the first ``i`` places."""
        start, stop = self._range(symbol, i)
        return stop - start

    def select(self, symbol: int, k: int) -> int:
        """The place of occurrence ``k`` of ``symbol``, from 0."""
        start, stop = self._range(symbol, self.n)
        if not 0 <= k < stop - start:
            raise IndexError(f"{symbol} stands {stop - start} times")
        i = start + k
        for level in range(len(self.planes) - 1, -1, -1):
            ones = symbol >> len(self.planes) - 1 - level & 1
            i = self._nth(level, ones, i - self.zeros[level] if ones else i)
        return i

    def _nth(self, level: int, bit: int, k: int) -> int:
        """The place of one or zero bit ``k`` of a plane, from 0."""
        counts = self.counts[level].astype(np.int64)
        if not bit:
            counts = np.arange(len(counts)) * BLOCK - counts
        block = int(np.searchsorted(counts, k, "right")) - 1
        start = block * BLOCK // 8
        bits = np.unpackbits(self.planes[level][start : start + BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(bits == bit)[k - counts[block]])

    def to_array(self) -> np.ndarray:
        """All ids in order: the planes undone from the lowest up."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for b, (zeros, plane) in enumerate(zip(reversed(self.zeros), reversed(self.planes), strict=True)):
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            up = np.empty_like(now)
            up[np.flatnonzero(~ones)] = now[:zeros]
            up[np.flatnonzero(ones)] = now[zeros:] | 1 << b
            now = up
        return now


# Pieces and words kept in a worker's cache; a full cache starts anew.
CACHE_PIECES = 1_200_000
# Bytes of text encoded at once.
ENCODE_BYTES = 8 << 20
# A control character between pieces that are encoded together, and how many are; how many words are.
MARK, TOGETHER, WORDS_TOGETHER = b"\x01", 512, 256
# Fixed value: how the vocabulary file parts lower-cased text into words. Plain text can be parted likewise beforehand.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Plain: ASCII white space and printable ASCII, and Latin letters that are one code point in NFC, which lower case turns
# into one such letter.
NOT_PLAIN = r"[^\x09-\x0D -~\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{148}\x{14A}-\x{17F}]"
# Words of plain text in lower case that are not all letters: what stands between them is.
OTHER_WORD = r"('s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\x09-\x0D 0-9a-z\x{DF}-\x{F6}\x{F8}-\x{17F}]+)"
LETTER_OF = dict(enumerate(byte_letters()))


class _Library:
    """A tokenizers file; ``worded`` tells whether plain text can be parted into words before the library sees it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # The model alone, over words in byte letters.
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # What text has that is not plain, special tokens among it.
        self.other = "|".join([NOT_PLAIN, *(re.escape(t["content"]) for t in spec["added_tokens"])])
        self.mark = self.library.encode(MARK.decode(), add_special_tokens=False).ids
        vocab, suffix = self.library.get_vocab(with_added_tokens=False), spec["model"].get("end_of_word_suffix")
        # A word ends where a token with the suffix does, provided that each byte has one.
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        rule = WORD_RULE in json.dumps(spec["pre_tokenizer"]).replace("\\\\", "\\")
        lower = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
        bytes_ = bool(suffix) and all(c in vocab and c + suffix in vocab for c in LETTER_OF.values())
        # Special tokens are found before lower case; one of letters alone could be taken for a word afterwards.
        apart = not any(t["normalized"] or t["content"].strip("'").isalpha() for t in spec["added_tokens"])
        self.worded = rule and lower and bytes_ and apart

    def pieces(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Pieces with their ids. Many go through the library as one text, parted by a mark with an id of its own."""
        alone = [p for p in pieces if len(self.mark) > 1 or MARK in p]
        for p, e in zip(alone, self.library.encode_batch([p.decode() for p in alone], add_special_tokens=False), strict=True):
            yield p, np.array(e.ids, "<u4").tobytes()
        rest = [p for p in pieces if MARK not in p] if len(self.mark) == 1 else []
        groups = [rest[i : i + TOGETHER] for i in range(0, len(rest), TOGETHER)]
        between = b" " + MARK + b" "
        for i in range(0, len(groups), 64):
            made = self.library.encode_batch_fast([between.join(g).decode() for g in groups[i : i + 64]], add_special_tokens=False)
            for group, e in zip(groups[i : i + 64], made, strict=True):
                ids = np.array(e.ids, "<u4")
                data, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == self.mark[0])).tolist()
                yield from ((p, data[a:b]) for p, a, b in zip(group, [0, *(c + 4 for c in cuts)], [*cuts, len(data)], strict=True))

    def words(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Words of plain pieces with their ids: the model alone, as nothing is left to normalise or part."""
        texts = [w.decode() if w.isascii() else w.decode("latin-1").translate(LETTER_OF) for w in words]
        for i in range(0, len(words), WORDS_TOGETHER):
            (made,) = self.model.encode_batch_fast([" ".join(texts[i : i + WORDS_TOGETHER])], add_special_tokens=False)
            ids = np.array(made.ids, "<u4")
            data, cuts = ids.tobytes(), (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            yield from ((w, data[a:b]) for w, a, b in zip(words[i : i + WORDS_TOGETHER], [0, *cuts[:-1]], cuts, strict=True))

    def plain(self, texts: pa.Array) -> pa.Array:
        return pc.invert(pc.match_substring_regex(texts, self.other))

    def apart(self, texts: pa.Array) -> pa.Array:
        """Plain texts in lower case with their words set apart: other texts with the same ids, but fewer distinct pieces."""
        return pc.replace_substring_regex(pc.utf8_lower(texts), OTHER_WORD, r" \1 ")

    def encode(self, pieces: list[bytes], known: dict[bytes, bytes]) -> None:
        """Put the ids of pieces of any text into ``known``, with those of the words that plain ones consist of."""
        if self.worded:
            column = pa.array(pieces, pa.binary()).cast(pa.string())
            plain = self.plain(column)
            found, pieces = (list(compress(pieces, x.to_pylist())) for x in (plain, pc.invert(plain)))
            split, coded, words = parted(self.apart(column.filter(plain)))
            ids = list(map(known.get, words))
            new = [i for i, x in enumerate(ids) if x is None]
            for i, (w, x) in zip(new, self.words([words[i] for i in new]), strict=True):
                ids[i] = x
                if len(w) <= CACHE_BYTES:
                    known[w] = x
            known.update(zip(found, joined(split, coded, ids), strict=True))
        known.update(self.pieces(pieces))


@functools.lru_cache(maxsize=2)
def _library(path: str) -> _Library:
    return _Library(path)


_CACHES: dict[str, dict[bytes, bytes]] = {}


def library_ids(texts: list[bytes], path: str) -> list[bytes]:
    """Ids by the tokenizers library as little-endian 32-bit integers.

    The library drops white space before it merges, so texts are parted there and each distinct piece is encoded once.
    """
    library, known, column = _library(path), _CACHES.setdefault(path, {}), pa.array(texts, pa.binary()).cast(pa.string())
    if not library.worded:
        return gathered(column, known, library.encode, CACHE_PIECES)
    plain = library.plain(column)
    words = iter(gathered(library.apart(column.filter(plain)), known, lambda new, known: known.update(library.words(new)), CACHE_PIECES))
    others = iter(gathered(column.filter(pc.invert(plain)), known, library.encode, CACHE_PIECES))
    return [next(words if p else others) for p in plain.to_pylist()]


def encode_shards(docs: DataFrame, path: str, shard_tokens: int = SHARD_TOKENS, end_id: int = END_ID) -> DataFrame:
    """Shards of ``docs`` in ascending order of ``doc_id``."""
    shipped(docs.sparkSession)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, ids, docs_, size = TaskContext.get().partitionId(), 0, [], [], 0

        def shard() -> pa.RecordBatch:
            data = WaveletMatrix.build(np.frombuffer(b"".join(ids), "<u4")).to_bytes()
            row = {"part": part, "seq": seq, "doc_ids": docs_, "lengths": [len(x) // 4 for x in ids], "n_tokens": size, "planes": data}
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("planes", pa.binary())]))

        for batch, texts in slices(batches, size=ENCODE_BYTES):
            for doc, x in zip(batch.column(0).to_pylist(), library_ids(texts, path), strict=True):
                if size and size + len(x) // 4 + 1 > shard_tokens:
                    yield shard()
                    seq, ids, docs_, size = seq + 1, [], [], 0
                ids.append(x + end)
                docs_.append(doc)
                size += len(x) // 4 + 1
        if docs_:
            yield shard()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # Spark samples the range keys on the driver, so they hold the start of a text only; texts are sorted as a whole.
    ranges = rows.repartitionByRange("doc_id", F.substring("text", 1, RANGE_CHARS))
    return ranges.sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)


def write_shards(docs: DataFrame, path: str, folder: str, **options) -> None:
    encode_shards(docs, path, **options).write.option("compression", "none").parquet(folder)


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards with ``first``, the number of ids in all shards before."""
    shards = spark.read.schema(SCHEMA).parquet(folder)
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    # One small row per shard of a million ids.
    starts = shards.select("part", "seq", "n_tokens").withColumn("first", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))
    return shards.join(bounded(starts.select("part", "seq", "first")), ["part", "seq"])


def read_documents(shards: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every document: ``ids`` as little-endian unsigned 32-bit integers."""

    shipped(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = WaveletMatrix.from_bytes(row["planes"]).to_array().astype("<u4")
                stops = np.cumsum(row["lengths"])
                starts = stops - row["lengths"]
                data = [ids[a:b].tobytes() for a, b in zip(starts, stops, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["first"], pa.int64()), pa.array(data, pa.binary())], ["doc_id", "start", "ids"])

    return shards.select("doc_ids", "lengths", "first", "planes").mapInArrow(run, "doc_id bigint, start bigint, ids binary")


def count_token(shards: DataFrame, token: int) -> DataFrame:
    """``part, seq, n``: occurrences of a token per shard, from ranks alone."""

    shipped(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            n = [(w := WaveletMatrix.from_bytes(r["planes"])).rank(token, w.n) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["part", "seq", "n"])

    return shards.select("part", "seq", "planes").mapInArrow(run, "part int, seq int, n bigint")


def locate_token(shards: DataFrame, token: int) -> DataFrame:
    """``doc_id, place``: every occurrence of a token, by select; places count from 0 within the document."""

    shipped(shards.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                w = WaveletMatrix.from_bytes(row["planes"])
                places = np.array([w.select(token, k) for k in range(w.rank(token, w.n))], np.int64)
                stops = np.cumsum(row["lengths"])
                of = np.searchsorted(stops, places, "right")
                ids = pa.array(row["doc_ids"], pa.int64()).take(pa.array(of))
                yield pa.RecordBatch.from_arrays([ids, pa.array(places - (stops - row["lengths"])[of], pa.int64())], ["doc_id", "place"])

    return shards.select("doc_ids", "lengths", "planes").mapInArrow(run, "doc_id bigint, place bigint")


def crc32_of(tokens: DataFrame) -> DataFrame:
    return tokens.select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
