"""BPE encoding by speculation and verification, and decoding.

A word is first cut greedily into the longest vocabulary tokens. Such a cut is the exact encoding if each token is the
encoding of its own string and no merge would cross any border between two tokens. Whether a border holds depends on
the two tokens alone, so all borders of a batch of words are checked together with numpy: walking back in merge order
along the right edge of the left token and the left edge of the right one, no pair that lives at the same time may
merge before one of them is used up. Words with a border that fails are merged exactly, one merge after another.

Text is parted at ASCII white space, which the vocabulary's rules always drop. Every distinct piece is looked up once,
every distinct word encoded once, and both are kept in bounded caches of the worker.

Defined cases: a null or empty text has no tokens and decodes to the empty text. Repeated rows are encoded each.
Only the id column given and the text are kept, so extra columns cannot clash.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.chunks import CACHE_BYTES, gathered, holding, returned, slices
from millrace.llm.ship import shipped

NEVER = int(np.iinfo(np.int64).max)
# Bits of a token id inside packed numbers.
BITS = 24
LOW = (1 << BITS) - 1
# Pieces and words kept in a worker's caches; a full cache starts anew. In a pipeline other stages' caches lie beside them.
CACHE_PIECES, WORD_CACHE = 200_000, 120_000
# A control character between pieces that are parted together, and how many are.
MARK, TOGETHER = b"\x01", 512
SHORT = 100  # symbols up to which a list is faster than a queue
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


@functools.lru_cache(maxsize=2)
def token_names(path: str) -> list[str]:
    """Tokens by id, all that decoding needs; ids without a token have an empty name."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    names = [""] * (max(ids.values()) + 1)
    for name, i in ids.items():
        names[i] = name
    return names


class WordBpe:
    """A vocabulary file with merges and word ends, and encoding with it."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = token_names(path)
        size = len(self.names)
        self.letters = byte_letters()
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        special = b"|".join(re.escape(t.encode()) for t in self.special)
        # Whether a piece is printable ASCII without special tokens.
        self.plain = re.compile((b"(?!.*(?:" + special + b"))" if special else b"") + rb"[!-~]+").fullmatch
        mark = self.split(MARK.decode())
        self.mark = mark[0] if len(mark) == 1 and isinstance(mark[0], str) else None
        self.words: dict[str, bytes] = {}
        self._load_merges([tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]], size)

    def _load_merges(self, merges: list[tuple[str, str]], size: int) -> None:
        # Merges of packed pairs as packed numbers, the rank in front of the token.
        self.packed: dict[int, int] = {}
        born = np.full(size, -1, np.int64)
        left, right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        # The walk needs each token to come from one merge, after the merges of its parts.
        self.speculates = True
        for rank, (a, b) in enumerate(merges):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.speculates &= born[z] < 0 and x << BITS | y not in self.packed and born[x] < rank and born[y] < rank
            self.packed[x << BITS | y] = rank << BITS | z
            born[z], left[z], right[z] = rank, x, y
        self.born, self.left, self.right = born, left, right
        pairs, made = (np.fromiter(x, np.int64, len(self.packed)) for x in (self.packed.keys(), self.packed.values()))
        keys, ranks = (pairs >> BITS) * size + (pairs & LOW), made >> BITS
        order = np.argsort(keys)
        self.size, self.keys, self.ranks = size, keys[order], ranks[order]
        made = np.flatnonzero(born >= 0)
        holds = self.borders_hold(left[made], right[made], born[made])
        self.sound = born < 0
        for z, ok in sorted(zip(made.tolist(), holds.tolist(), strict=True), key=lambda x: born[x[0]]):
            self.sound[z] = ok and self.sound[left[z]] and self.sound[right[z]]
        # A trie of tokens that encode to themselves: a dict per prefix, with the token that ends there under "". A word's
        # end is marked by a letter that no byte has.
        self.trie: dict = {}
        for name, i in self.vocab.items():
            ends = bool(self.suffix) and name.endswith(self.suffix) and len(name) > len(self.suffix)
            name = name[: -len(self.suffix)] + "\0" if ends else name
            if self.sound[i]:
                node = self.trie
                for c in name:
                    node = node.setdefault(c, {})
                node[""] = i

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs, ``NEVER`` for pairs that do not merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER) if len(self.keys) else np.full(len(key), NEVER)

    def borders_hold(self, a: np.ndarray, b: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge crosses from token ``a`` to token ``b`` (before merge ``until``)."""
        x, y = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        end_x = np.full(len(x), NEVER) if until is None else until.copy()
        end_y = end_x.copy()
        ok, open_ = np.ones(len(x), bool), np.arange(len(x))
        while len(open_):
            u, v = x[open_], y[open_]
            rank = self.rank_of(u, v)
            # On equal rank the merge further left comes first: the one that uses up x, but not the one for y.
            crosses = (rank < end_x[open_]) & (rank <= end_y[open_])
            crosses &= rank < NEVER
            ok[open_[crosses]] = False
            bu, bv = self.born[u], self.born[v]
            goes = ~crosses & (np.maximum(bu, bv) >= 0)
            on_x = open_[goes & (bu >= bv)]
            on_y = open_[goes & (bu < bv)]
            end_x[on_x], x[on_x] = self.born[x[on_x]], self.right[x[on_x]]
            end_y[on_y], y[on_y] = self.born[y[on_y]], self.left[y[on_y]]
            open_ = open_[goes]
        return ok

    def greedy(self, word: str) -> list[int]:
        """Longest sound tokens from the left; ``word`` is in byte letters and ends in the end mark."""
        out, i, last, trie = [], 0, len(word) - 1, self.trie
        while i <= last:
            best, stop, j, node = -1, i, i, trie
            while j <= last and (node := node.get(word[j])) is not None:
                j += 1
                if j != last and (token := node.get("", -1)) >= 0:  # the end mark never stands alone
                    best, stop = token, j
            if best < 0:
                raise ValueError(f"no token starts {word[i:]!r}")
            out.append(best)
            i = stop
        return out

    def merge(self, word: str) -> list[int]:
        """Exact merging: always the lowest-ranked pair, the leftmost of equal ones."""
        plain = word.removesuffix("\0")
        ids = [self.vocab[c] for c in plain]
        if plain != word:
            ids[-1] = self.vocab[plain[-1] + self.suffix]
        return self._merge_short(ids) if len(ids) <= SHORT else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        # Pairs and their merges as whole numbers, the merge with its rank in front, so that the least one comes first.
        find = self.packed.get
        found = [find(a << BITS | b, NEVER) for a, b in zip(ids, ids[1:])]
        while found and (best := min(found)) != NEVER:
            i = found.index(best)
            ids[i : i + 2] = [best & LOW]
            del found[i]
            if i:
                found[i - 1] = find(ids[i - 1] << BITS | ids[i], NEVER)
            if i < len(found):
                found[i] = find(ids[i] << BITS | ids[i + 1], NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = [(m >> BITS, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (m := self.packed.get(ids[i] << BITS | ids[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.packed[a << BITS | b] & LOW, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < len(ids) and (m := self.packed.get(ids[k] << BITS | ids[after[k]])) is not None:
                    heapq.heappush(queue, (m >> BITS, k, ids[k], ids[after[k]]))
        return [t for t in ids if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Words in byte letters with the end mark: speculate, check all borders at once, merge what fails."""
        if not self.speculates:
            return [self.merge(w) for w in words]
        cuts = [self.greedy(w) for w in words]
        flat = np.fromiter((t for c in cuts for t in c), np.int64)
        of = np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
        inner = np.flatnonzero(of[1:] == of[:-1]) if len(of) else of
        pairs, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        holds = self.borders_hold(pairs // self.size, pairs % self.size)
        for i in np.unique(of[inner[~holds[back]]]):
            cuts[i] = self.merge(words[i])
        return cuts

    def split(self, text: str) -> list[str | int]:
        """Words of a text in byte letters, and ids of special tokens in it."""
        out: list[str | int] = []
        for part in self.special_pattern.split(text) if self.special_pattern else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += [w + "\0" for w, _ in self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(part))]
        return out

    def split_all(self, pieces: list[bytes]) -> Iterator[tuple[bytes, list[str | int]]]:
        """Pieces with their words. Many go through the library as one text, parted by a mark that is a word of its own."""
        alone = [p for p in pieces if self.mark is None or MARK in p]
        yield from ((p, self.split(p.decode())) for p in alone)
        rest = [p for p in pieces if MARK not in p] if self.mark is not None else []
        for i in range(0, len(rest), TOGETHER):
            group, words = rest[i : i + TOGETHER], []
            done = iter(group)
            for w in self.split((b" " + MARK + b" ").join(group).decode()):
                if w == self.mark:
                    yield next(done), words
                    words = []
                else:
                    words.append(w)
            yield next(done), words

    def fill(self, pieces: list[bytes], known: dict[bytes, bytes]) -> None:
        """Put the ids of pieces into ``known``; words that several pieces have are encoded once."""
        plain = [p for p in pieces if self.plain(p)]
        # Printable ASCII bytes stand for themselves.
        parts = {p: [w + "\0" for w in ASCII_WORD.findall(p.decode("ascii").lower())] for p in plain}
        parts.update(self.split_all([p for p in pieces if p not in parts]))
        words = {w for p in parts.values() for w in p if isinstance(w, str)}
        new = [w for w in words if w not in self.words]
        if len(self.words) + len(new) > WORD_CACHE:
            self.words.clear()
            new = list(words)
        made = self.encode_words(new)
        self.words.update((w, struct.pack(f"<{len(ids)}I", *ids)) for w, ids in zip(new, made, strict=True))
        get = lambda w: self.words[w] if isinstance(w, str) else struct.pack("<I", w)
        known.update((p, get(ws[0]) if len(ws) == 1 else b"".join(map(get, ws))) for p, ws in parts.items())
        for w in [w for w in new if len(w) > CACHE_BYTES]:
            del self.words[w]

    def failing(self, words: list[str]) -> int:
        """How many of these words the greedy cut gets wrong."""
        return sum(self.greedy(w) != ids for w, ids in zip(words, self.encode_words(words), strict=True))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids. Such a vocabulary file names no decoder, so tokens are parted by spaces."""
        return " ".join(self.names[i] for i in ids if i < self.size and self.names[i])


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    return WordBpe(path)


_CACHES: dict[str, dict[bytes, bytes]] = {}


def _release() -> None:
    _CACHES.clear()
    vocabulary.cache_clear()


def encode_texts(texts: list[bytes], path: str) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    holding("bpe", _release)
    return gathered(texts, _CACHES.setdefault(path, {}), vocabulary(path).fill, CACHE_PIECES)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """``id_column`` and ``ids``: token ids as little-endian unsigned 32-bit integers, one row per document row.

    ``path`` names the vocabulary file on the executors.
    """
    shipped(docs.sparkSession)
    rows = docs.select(id_column, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(encode_texts(texts, path), pa.binary())], [id_column, "ids"])
        # The worker may wait for long or be given to another stage.
        _CACHES.clear()
        vocabulary(path).words.clear()
        returned()

    return rows.mapInArrow(run, f"{rows.schema[id_column].name} {rows.schema[id_column].dataType.simpleString()}, ids binary")


def decode(tokens: DataFrame, path: str, id_column: str = "doc_id") -> DataFrame:
    """``tokens`` with the column ``decoded``, the text of ``ids``; null ids give null."""
    shipped(tokens.sparkSession)
    kind = tokens.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(token_names(path), object)
        for batch, ids in slices(batches, "ids"):
            texts = [" ".join(names[np.frombuffer(x, "<u4")].tolist()) for x in ids]
            null = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string(), mask=null)], [id_column, "ids", "decoded"])

    return tokens.select(id_column, "ids").mapInArrow(run, f"{id_column} {kind}, ids binary, decoded string")


def digests(tokens: DataFrame, *others: str) -> DataFrame:
    """Number of ids, and SHA-256 of the ids and of the decoded text, after ``doc_id`` and other columns."""
    return tokens.select(
        "doc_id",
        *others,
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
