"""Quality rules on tokeniser fertility.

Every word of a text is cut by a public piece vocabulary with byte fallback. Characters per token, the share of
byte tokens and the entropy of the tokens say how far a text is from what the vocabulary was made for; a text is
rejected outside the band of its language or script. Plain counts of symbols, repeated lines and repeated 5-word
windows reject broken texts first.

Defined cases: a null or empty text has no words and fails the base rules. A language without a band of its own, or
none, takes the band of the script that most letters of the text are in. A script without a band rejects nothing, and
a text without letters takes the default band. Rows are judged each by itself, so repeated rows keep their rows.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.chunks import CACHE_BYTES, CACHE_WORDS, holding, pieces
from millrace.llm.ship import shipped

GRAM = 5
# (least characters per token, most, most byte tokens per token, least entropy over that of equally frequent tokens)
DEFAULT_BAND = (1.2, 8.0, 0.25, 0.45)
BANDS: dict[str, tuple[float, float, float, float]] = {
    "en": (1.3, 8.0, 0.10, 0.45),
    "de": (1.2, 8.0, 0.10, 0.45),
    "fr": (1.2, 8.0, 0.10, 0.45),
    "es": (1.2, 8.0, 0.10, 0.45),
}
# By script: the blocks of its letters and the band. Low bounds are at most three quarters of what ordinary passages reach,
# as the vocabulary cuts most of these into single letters.
SCRIPTS: dict[str, tuple[tuple[tuple[int, int], ...], tuple[float, float, float, float]]] = {
    "latin": (((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)), (0.7, 8.0, 0.25, 0.45)),
    "greek": (((0x370, 0x3FF), (0x1F00, 0x1FFF)), (0.6, 8.0, 0.35, 0.3)),
    "cyrillic": (((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)), (1.0, 8.0, 0.25, 0.4)),
    "armenian": (((0x530, 0x58F),), (0.55, 8.0, 0.35, 0.3)),
    "hebrew": (((0x590, 0x5FF), (0xFB1D, 0xFB4F)), (0.55, 8.0, 0.35, 0.3)),
    "arabic": (((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFC)), (0.55, 8.0, 0.35, 0.3)),
    "devanagari": (((0x900, 0x97F), (0xA8E0, 0xA8FF)), (0.5, 8.0, 0.4, 0.3)),
    "bengali": (((0x980, 0x9FF),), (0.5, 8.0, 0.4, 0.3)),
    "tamil": (((0xB80, 0xBFF),), (0.55, 8.0, 0.35, 0.3)),
    "thai": (((0xE00, 0xE7F),), (0.6, 8.0, 0.3, 0.3)),
    "georgian": (((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)), (0.6, 8.0, 0.3, 0.3)),
    "hangul": (((0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)), (0.45, 8.0, 0.6, 0.35)),
    # Chinese and Japanese
    "han": (((0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3040, 0x312F), (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x323AF)), (0.45, 8.0, 0.7, 0.35)),
}
# Texts with fewer tokens say too little about the language to be judged by a band.
LEAST_TOKENS = 20
# Entropy of prose levels off: the bound on it grows up to so many tokens and is the same for all longer texts.
LEVEL_TOKENS = 4096

FIELDS = [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens", "n_byte_tokens", "script")]
STRUCT = pa.struct([*FIELDS, ("entropy", pa.float64())])
DDL = "struct<" + ",".join(f"{n}:bigint" for n, _ in FIELDS) + ",entropy:double>"

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(b"#*$%&|<>")] = True
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b" \t\n\x0b\x0c\r")] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
# Numbers of scripts follow the order of SCRIPTS.
OTHER, NO_LETTERS = len(SCRIPTS), -1
_LAST_LETTER = 0x323AF


@functools.lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


class _Words:
    """Numbers of words, with the tokens of each."""

    def __init__(self, path: str):
        self.model, self.is_byte = _pieces(path)
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.tokens: list[bytes] = []

    def numbers(self, words: list[bytes]) -> np.ndarray:
        new = [w for w in set(words) if w not in self.number]
        if len(self.number) + len(new) > CACHE_WORDS:
            self.clear()
            new = list(set(words))
        for w, ids in zip(new, self.model.encode([w.decode() for w in new], num_threads=1) if new else (), strict=True):
            self.number[w] = len(self.tokens)
            self.tokens.append(np.array(ids, np.uint16).tobytes())
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def trim(self) -> None:
        """Drop all if words are held that are too long to keep."""
        if sum(len(t) for t in self.tokens[-1000:]) > 1000 * 2 * CACHE_BYTES:
            self.clear()


_CACHE: dict[str, _Words] = {}


@functools.lru_cache(maxsize=1)
def _script_of() -> np.ndarray:
    """Number of the script of each code point that is a letter or stands on one, ``NO_LETTERS`` for others."""
    script = np.full(0x110000, NO_LETTERS, np.int8)
    letters = [c for c in range(_LAST_LETTER + 1) if unicodedata.category(chr(c))[0] in "LM"]
    script[letters] = OTHER
    for i, (blocks, _) in enumerate(SCRIPTS.values()):
        for low, high in blocks:
            script[low : high + 1][script[low : high + 1] == OTHER] = i
    script[0x300:0x370][script[0x300:0x370] == OTHER] = NO_LETTERS  # accents belong to any script
    return script


def _scripts(raw: np.ndarray, edges: np.ndarray, ascii_letters: np.ndarray) -> np.ndarray:
    """Number of the script that most letters of each text are in."""
    at = np.flatnonzero(raw >= 0xC2)
    lead = raw[at].astype(np.int32)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    code = lead & np.array([0, 0, 0x1F, 0x0F, 0x07])[size]
    for k in (1, 2, 3):
        tail = raw[np.minimum(at + k, len(raw) - 1)] & 0x3F
        code = np.where(size > k, code << 6 | tail, code)
    script = _script_of()[np.minimum(code, 0x10FFFF)]
    known = script != NO_LETTERS
    doc = np.searchsorted(edges, at[known], "right") - 1
    n, kinds = len(edges) - 1, len(SCRIPTS) + 1
    counts = np.bincount(doc * kinds + script[known], minlength=n * kinds).reshape(n, kinds)
    counts[:, 0] += ascii_letters
    return np.where(counts.any(1), counts.argmax(1), NO_LETTERS)


def _repeats(number: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words per document inside 5-word windows that stand twice or more in it."""
    n = len(number)
    covered = np.zeros(n_docs, np.int64)
    if n < GRAM:
        return covered
    start = np.flatnonzero(doc[: n - GRAM + 1] == doc[GRAM - 1 :])
    rank = number
    for k in range(1, GRAM):  # equal ranks: equal windows of k + 1 words
        rank = np.unique(rank[: n - k] * (int(number.max()) + 1) + number[k:], return_inverse=True)[1]
    key = doc[start] * n + rank[start]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(n + 1, np.int64)
    twice = start[count[back] > 1]
    edge[twice] += 1
    edge[twice + GRAM] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[inside], minlength=n_docs)


def _release() -> None:
    _CACHE.clear()
    _pieces.cache_clear()


def _measure(texts: list[bytes], path: str) -> dict[str, np.ndarray]:
    holding("fertility", _release)
    words = _CACHE.setdefault(path, _Words(path))
    split = [t.split() for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    flat = [w for s in split for w in s]
    number = words.numbers(flat)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    per_text = lambda mask: np.diff(np.concatenate(([0], np.cumsum(mask)))[edges])
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    tokens = [np.frombuffer(b"".join(map(words.tokens.__getitem__, number[a:b].tolist())), np.uint16) for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts), strict=True)]
    entropy = np.zeros(len(texts))
    for i, t in enumerate(tokens):
        if len(t):
            n = np.bincount(t)
            n = n[n > 0]
            entropy[i] = max(0.0, np.log2(len(t)) - (n * np.log2(n)).sum() / len(t))
    out = {
        "n_words": counts,
        "word_chars": per_text((raw & 0xC0 != 0x80) & ~_IS_SPACE[raw]),
        "n_symbols": per_text(_IS_SYMBOL[raw]),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": _repeats(number, np.repeat(np.arange(len(texts)), counts), len(texts)),
        "n_tokens": np.array([len(t) for t in tokens], np.int64),
        "n_byte_tokens": np.array([words.is_byte[t].sum() for t in tokens], np.int64),
        "script": _scripts(raw, edges, per_text(_IS_LETTER[raw])),
        "entropy": entropy,
    }
    words.trim()
    return out


def _measured(text: Column, path: str) -> Column:
    @F.arrow_udf(DDL)
    def measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            done = [_measure(t, path) for _, t in pieces(column)]
            columns = [np.concatenate([d[f.name] for d in done]) if done else np.zeros(0) for f in STRUCT]
            yield pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, STRUCT, strict=True)], fields=list(STRUCT))

    return measure.asNondeterministic()(text)  # so that Spark works it out once per row


def _verdict(m: Column, band: Column) -> Column:
    tokens = m["n_tokens"]
    chars = m["word_chars"] / F.greatest(tokens, F.lit(1))
    most = F.log2(F.least(F.greatest(tokens, F.lit(1)), F.lit(LEVEL_TOKENS)).cast("double"))
    fits = chars.between(band["low"], band["high"]) & (m["n_byte_tokens"] <= band["bytes"] * tokens) & (m["entropy"] >= band["spread"] * most)
    return (tokens < LEAST_TOKENS) | band["low"].isNull() | fits


def measured(docs: DataFrame, path: str, lang: str | None = "lang", bands=None, default=DEFAULT_BAND, least_words: int = 10, most_repeat: int = 20, name: str = "quality") -> DataFrame:
    """``docs`` with the column ``name``: the measures, ``base_failed`` and ``kept``.

    ``path`` names the vocabulary file on the executors, ``lang`` the language column. ``default`` is the band of texts
    without letters.
    """
    shipped(docs.sparkSession)
    bands = BANDS if bands is None else bands
    struct = lambda b: F.struct(*(F.lit(float(x)).alias(n) for x, n in zip(b, ("low", "high", "bytes", "spread"), strict=True)))
    m = F.col(name)
    band = F.when(m["script"] == NO_LETTERS, struct(default))
    for i, (_, b) in enumerate(SCRIPTS.values()):
        band = band.when(m["script"] == i, struct(b))
    if lang and lang in docs.columns:
        for tongue, b in bands.items():
            band = F.when(F.col(lang) == tongue, struct(b)).otherwise(band)
    own = docs.withColumn(name, _measured(F.col("text"), path))
    failed = (m["n_words"] < least_words) | (100 * m["n_repeat_words"] > most_repeat * m["n_words"])
    fields = [m[n].alias(n) for n in (*(n for n, _ in FIELDS), "entropy")]
    return own.withColumn(name, F.struct(*fields, failed.alias("base_failed"), (~failed & _verdict(m, band)).alias("kept")))
