"""Collocated phrases of two to four words, by top-order marginalisation.

Every place in a text begins one window: its word and the next ones, as lead columns ``w0`` to ``w3`` that are padded
with null where the piece of text ends. Only these longest windows are counted. Each occurrence of a shorter phrase is
the beginning of one window, so ROLLUP over the window columns sums the counts of all shorter phrases, of single words
and of all words of a language; n-grams of the lower orders are never made.

Most windows of a large text stand a few times and hold no phrase of ``least`` occurrences. A first pass counts
window beginnings by hashed keys of 40 bits. They are dealt by the first bits of the key, so that no task holds more
than its share of them, and travel as gaps between sorted keys, two to three bytes each. A beginning never stands more
often than the count of its key says, so a window may be padded from the first beginning whose key stands less than
``least`` times: no phrase of ``least`` occurrences is touched, whatever collides, and its counts are exact. The
frequent keys go out as a table of bits, two to a key, that grows with their number up to ``BUCKETS`` bits; a fuller
table only lets more windows through. The files of the first shuffle go before the windows are dealt.

Defined cases: a null or empty text has no words; null ``lang`` is ``und`` and joins rows that say ``und``. Repeated
rows count as often as they stand. Only ``lang`` and ``text`` are read, so other columns cannot clash. Phrases that tie
in score and count follow in UTF-8 byte order. A text that is null everywhere gives an empty result.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.chunks import pieces
from millrace.llm.ship import shipped
from millrace.llm.words import bounded, stored
from millrace.session import shuffles_dropped

LEAST, LONGEST, TOP = 30, 4, 2000
SHARE = 80  # per cent of a phrase's occurrences inside one longer phrase that remove it
WORDS = [f"w{i}" for i in range(LONGEST)]
# Characters that end a piece become line breaks, and blanks inside a piece spaces.
FORMS = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
# Text counted at once in a task; Spark adds up what such stretches have in common.
CHUNK_BYTES = 2 << 20
# Bits of the table of frequent beginnings at most, a power of two, and how many of them each beginning is to have.
BUCKETS, ROOM = 1 << 29, 16
# Keys are dealt by their first bits in up to this many blocks; inside its block a key has the other 28 bits.
BLOCKS, REST = 1 << 12, 28
# Keys gathered in a task before they are sorted and sent.
HELD_KEYS = 6_000_000
# Odd multipliers that mix hashes and give a beginning its two places.
ODD, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _Chunk:
    """Words of texts of one language as codes; ``ends`` tells codes of breaks between pieces."""

    def __init__(self, lang: str, texts: list[bytes]):
        data = b"\n".join(texts).lower().translate(FORMS).replace(b"\n", b" \n ")
        coded = pc.split_pattern(pa.array([data], pa.binary()), b" ").flatten().dictionary_encode()
        self.lang, self.words = lang, coded.dictionary
        codes, words = coded.indices.to_numpy(), self.words.to_pylist()
        self.codes = codes[codes != words.index(b"")] if b"" in words else codes
        self.ends = words.index(b"\n") if b"\n" in words else -1
        seed = zlib.crc32(lang.encode())
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))

    def windows(self, blocks: int, may: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per order: the places of the first words of the windows that go on so far, and the keys of their beginnings.

        ``blocks`` is a power of two. Without ``may``, the table of frequent keys, no window is padded before its piece ends.
        """
        first = self.codes
        open_ = np.flatnonzero(first != self.ends)
        mix = np.zeros(len(open_), np.uint64)
        for order in range(LONGEST):
            at = open_ + order
            inside = at < len(first)
            inside[inside] = first[at[inside]] != self.ends
            open_, mix = open_[inside], mix[inside]
            mix = (mix ^ self.hashes[first[open_ + order]]) * ODD
            mix ^= mix >> np.uint64(29)
            keys = mix * ODD >> np.uint64(64 - REST - blocks.bit_length() + 1)
            if may is not None:
                into = _places(keys, 8 * len(may) // blocks)
                frequent = (may[into >> 3] >> (into & 7) & 1).all(0)
                open_, mix, keys = open_[frequent], mix[frequent], keys[frequent]
            yield open_, keys

    def counted(self, blocks: int, may: np.ndarray) -> pa.Table:
        """The windows, as their words with spaces between, and how often they stand."""
        starts = np.flatnonzero(self.codes != self.ends)
        columns = []
        for order, (open_, _) in enumerate(self.windows(blocks, may)):
            column = np.full(len(starts), -1, np.int32)
            column[np.searchsorted(starts, open_)] = self.codes[open_ + order]
            columns.append(column)
        counts = pa.table(columns, WORDS).group_by(WORDS, use_threads=False).aggregate([([], "count_all")])
        texts = self.words.cast(pa.string())
        named = [texts.take(pa.array(c := counts[w].to_numpy(), mask=c < 0)) for w in WORDS]
        window = pc.ascii_rtrim(pc.binary_join_element_wise(*named, pa.scalar(" "), null_handling="replace", null_replacement=""), " ")
        return pa.table([pa.array([self.lang] * len(counts), pa.string()), window, counts["count_all"]], ["lang", "window", "n"])


def _places(keys: np.ndarray, area: int) -> np.ndarray:
    """The two bits of each key in a table that has ``area`` of them, a power of two, for each block."""
    rest = keys & np.uint64((1 << REST) - 1)
    other = (rest * OTHER & np.uint64((1 << REST) - 1)) >> np.uint64(REST - area.bit_length() + 1)
    return ((keys >> np.uint64(REST)) * np.uint64(area) + np.stack([rest & np.uint64(area - 1), other])).astype(np.int64)


def _packed(keys: np.ndarray, blocks: int, top: int) -> Iterator[tuple[int, int, bytes]]:
    """Blocks that hold keys, with the number of their distinct keys, the gaps between these and how often each stands, at most ``top``."""
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
    n = np.minimum(np.diff(first, append=len(keys)), top).astype(np.uint8)
    keys = keys[first]
    starts = np.arange(blocks + 1, dtype=np.uint64) << np.uint64(REST)
    bounds = np.searchsorted(keys, starts)
    gaps = np.diff(keys, prepend=np.uint64(0))
    held = np.flatnonzero(np.diff(bounds))
    gaps[bounds[held]] = keys[bounds[held]] - starts[held]
    # The lower two bytes are as good as random; the others and the counts are small.
    low, high = gaps.astype("<u2"), [(gaps >> np.uint64(s)).astype(np.uint8) for s in (16, 24)]
    for block, start, stop in zip(held.tolist(), bounds[held].tolist(), bounds[held + 1].tolist()):
        yield block, stop - start, low[start:stop].tobytes() + zlib.compress(b"".join(x[start:stop].tobytes() for x in (*high, n)), 1)


def _unpacked(size: int, part: bytes) -> np.ndarray:
    """Keys without their block, and in the lowest byte of each how often it stands."""
    low = np.frombuffer(part, "<u2", size).astype(np.uint64)
    high, most, n = np.frombuffer(zlib.decompress(memoryview(part)[2 * size :]), np.uint8).reshape(3, size).astype(np.uint64)
    return np.cumsum(low | high << np.uint64(16) | most << np.uint64(24), dtype=np.uint64) << np.uint64(8) | n


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[_Chunk]:
    """Texts gathered by language until they reach ``most`` bytes; a longer text is a chunk of its own."""
    held: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for start, texts in pieces(batch.column("text")):
            for lang, text in zip(batch.column("lang").slice(start, len(texts)).to_pylist(), texts, strict=True):
                if text:
                    held.setdefault(lang, []).append(text)
                    size[lang] = size.get(lang, 0) + len(text)
            while sum(size.values()) >= most:
                lang = max(size, key=size.__getitem__)
                del size[lang]
                yield _Chunk(lang, held.pop(lang))
    while held:
        yield _Chunk(*held.popitem())


def _rows(docs: DataFrame) -> DataFrame:
    shipped(docs.sparkSession)
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def _blocks(buckets: int) -> int:
    """Blocks of keys; each has one byte of the table at least."""
    return min(BLOCKS, buckets // 8)


def frequent_keys(docs: DataFrame, least: int, blocks: int, chunk_bytes: int) -> DataFrame:
    """``block, size, part``: the keys of window beginnings that may stand ``least`` times, four bytes each."""
    top, kind = min(least, 255), "block int, size int, part binary"
    schema = pa.schema([("block", pa.int32()), ("size", pa.int32()), ("part", pa.binary())])

    def sent(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> Iterator[pa.RecordBatch]:
            keys = np.concatenate(held)
            held.clear()
            packed = _packed(keys, blocks, top)
            del keys
            while rows := list(itertools.islice(packed, 500)):
                yield sent(rows)

        held: list[np.ndarray] = []
        for chunk in _chunks(batches, chunk_bytes):
            for _, keys in chunk.windows(blocks):
                held.append(keys)
            if sum(map(len, held)) >= HELD_KEYS:
                yield from flushed()
        if sum(map(len, held)):
            yield from flushed()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for block, parts in itertools.groupby(rows, lambda r: r[0]):
            found = np.concatenate([_unpacked(size, part) for _, size, part in parts])
            found.sort()
            keys = found >> np.uint64(8)
            first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
            frequent = keys[first][np.add.reduceat(found & np.uint64(255), first) >= top]
            if len(frequent):
                yield sent([(block, len(frequent), frequent.astype("<u4").tobytes())])

    return _rows(docs).mapInArrow(count, kind).repartition("block").sortWithinPartitions("block").mapInArrow(add, kind)


def frequent_bits(docs: DataFrame, least: int, buckets: int, chunk_bytes: int) -> bytes:
    """A table of up to ``buckets`` bits with both bits of every key of ``frequent_keys`` set."""
    blocks = _blocks(buckets)
    with shuffles_dropped(docs.sparkSession):
        found = stored(frequent_keys(docs, least, blocks, chunk_bytes), "beginnings")
    total = found.agg(F.sum(F.col("size").cast("bigint"))).first()[0] or 0
    area = max(8, min(buckets, 1 << (ROOM * total).bit_length()) // blocks)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for part in batch.column("part").to_pylist():
                own = np.zeros(area, np.uint8)
                own[_places(np.frombuffer(part, "<u4").astype(np.uint64), area)] = 1
                bits.append(np.packbits(own, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(bits, pa.binary())], ["block", "part"])

    out = bytearray(blocks * area // 8)
    # Few partitions, as each is fetched by a job of its own.
    for row in found.coalesce(16).mapInArrow(mark, "block int, part binary").toLocalIterator():
        out[row.block * area // 8 : (row.block + 1) * area // 8] = row.part
    return bytes(out)


def windows(docs: DataFrame, least: int = LEAST, buckets: int = BUCKETS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``lang, w0, w1, w2, w3, n``: the longest windows and how often they stand, padded with null."""
    rows, blocks = _rows(docs), _blocks(buckets)
    table = docs.sparkSession.sparkContext.broadcast(frequent_bits(docs, least, buckets, chunk_bytes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may = np.frombuffer(table.value, np.uint8)
        for chunk in _chunks(batches, chunk_bytes):
            yield from chunk.counted(blocks, may).to_batches(max_chunksize=20_000)

    counted = rows.mapInArrow(run, "lang string, window string, n bigint").groupBy("lang", "window").agg(F.sum("n").alias("n"))
    # One text a window is shorter in the shuffle than its words; no word is empty or has a space.
    word = F.split("window", " ")
    return counted.select("lang", *(F.nullif(F.get(word, F.lit(i)), F.lit("")).alias(w) for i, w in enumerate(WORDS)), "n")


def phrase_counts(docs: DataFrame, least: int = LEAST, **sizes: int) -> DataFrame:
    """``lang, words, f``: every phrase of up to four words that stands ``least`` times, and no words for a whole language."""
    summed = windows(docs, least, **sizes).rollup("lang", *WORDS).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    # Level of the rollup: how many of the words are left. Padded windows end above the level of their padding.
    kept = F.col("rolled") == (1 << LONGEST) - 1
    for order in range(1, LONGEST + 1):
        kept |= (F.col("rolled") == (1 << LONGEST - order) - 1) & F.col(WORDS[order - 1]).isNotNull() & (F.col("f") >= least)
    return summed.where(kept).select("lang", F.array_compact(F.array(*WORDS)).alias("words"), "f")


def _wide(value: Column) -> Column:
    return value.cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, **sizes: int) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``score`` is that of the weakest cut of the phrase in two, and ``l`` and ``r`` are its parts' counts. Phrases that
    stand ``share`` per cent of the time inside one longer phrase are left out. ``sizes`` are those of ``windows``.
    """
    made = phrase_counts(docs, least, **sizes)
    with shuffles_dropped(docs.sparkSession):
        counts = stored(made, "phrases")
    named = counts.select("lang", "words", F.array_join("words", " ").alias("phrase"), F.size("words").alias("m"), "f")
    candidates = named.where("m >= 2")
    texts = named.where("m >= 1").select("lang", "phrase", "f")

    cut = F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "words", "m", F.col("f").alias("a"), cut)
    part = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("first"), part(F.col("k") + 1, F.col("m") - F.col("k")).alias("rest"))
    texts = bounded(texts)
    for side, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(texts.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)), ["lang", side])
    both = _wide(F.col("l")) + _wide(F.col("r"))
    cuts = cuts.select("lang", "phrase", "a", "k", "l", "r", (F.lit(2_000_000).cast("decimal(7,0)") * _wide(F.col("a"))).alias("top"), both.alias("both"))
    cuts = cuts.select("lang", "phrase", "a", F.struct(F.expr("top div both").alias("score"), "k", "l", "r").alias("cut"))
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min("cut").alias("cut"))

    spots = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("m") - n + 1), lambda i: F.array_join(F.slice("words", i, n), " ")))))
    longer = candidates.where("m >= 3").select("lang", spots.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("inside"))
    left = scored.join(longer, ["lang", "phrase"], "left")
    held = F.lit(100).cast("decimal(3,0)") * _wide(F.col("inside")) >= F.lit(share).cast("decimal(3,0)") * _wide(F.col("a"))
    left = left.where(~F.coalesce(held, F.lit(False)))

    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    words = bounded(named.where("m = 0").select("lang", F.col("f").alias("n")))
    columns = (F.col("rank").cast("bigint").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").cast("bigint").alias("score"))
    return best.join(words, "lang").select("lang", *columns)
