"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Each kind has a pattern that finds leftmost, non-overlapping candidates, a check (Luhn, mod 97, ranges), a score, and
cue words that raise the score when they stand near. Spans below the least score are dropped, except those of the
four base kinds, which stay whatever their score. Offsets are code points of the text, end exclusive.

Patterns never try two starts within one run of letters or digits and do not backtrack into one, so their time
follows the length of the text. All of it is column expressions on the row; nothing is shuffled.

Defined cases: a null or empty text has no spans. Rows are handled each by itself, so repeated rows keep their rows.
Extra columns pass through; one named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import fresh
from millrace.operators.once import computed_once

LEAST_SCORE = 0.5
NEAR = 40  # characters before and after a span that are searched for cue words
CUE_BONUS = 0.3
BLOCK = 512


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _ip_parts(hit: Column) -> Column:
    bare = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(hit, r"\."), lambda p: (F.length(bare(p)) < 3) | ((F.length(bare(p)) == 3) & (bare(p) <= "255")))


def _luhn(least: int, most: int) -> Callable[[Column], Column]:
    return lambda hit: F.length(_digits(hit)).between(least, most) & F.call_function("luhn_check", _digits(hit))


def _phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(8, 15)


def _mod97(hit: Column) -> Column:
    """The IBAN checksum: the first four characters go last, letters count from 10, and the rest by 97 is 1."""
    bare = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")

    def step(rest, c):
        code = F.ascii(c)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.length(bare).between(15, 34) & (F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), step) == 1)


def _ssn(hit: Column) -> Column:
    area, group, serial = (F.split(hit, "-")[i] for i in range(3))
    return ~area.isin("000", "666") & (area < "900") & (group != "00") & (serial != "0000")


class Kind(NamedTuple):
    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    cues: str = ""
    needs: str = ""  # a letter that every match has
    base: bool = False


# The base kinds, in the order in which spans are listed.
BASE = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda h: F.lit(True), 0.9, "mail|contact|write", "@", True),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip_parts, 0.6, "ip|address|host|server", ".", True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _luhn(16, 19), 0.7, "card|visa|credit|payment", "", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6, "phone|call|tel|mobile", "+", True),
)
MORE = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _mod97, 0.9, "iban|bank|account"),
    Kind("short_card", r"(?<![0-9-])[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{3,5}(?![0-9-])", _luhn(13, 15), 0.3, "card|visa|amex|credit|payment"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _ssn, 0.4, "ssn|social|security", "-"),
    Kind("secret", r"(?i)\b(?:token|api_?key|secret|password)\b\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+-]{16,}+[\"']?", lambda h: F.lit(True), 0.8, "", ""),
)
KINDS = BASE + MORE


def _before(x: Column) -> Column:
    """Sum of all numbers before each one, without its own; by copies, so for short arrays."""
    start = F.array(F.lit(0).cast("bigint"))
    sums = F.aggregate(x, start, lambda a, v: F.concat(a, F.array(F.element_at(a, -1) + v)))
    return F.slice(sums, F.lit(1), F.size(x))


def running(x: Column) -> Column:
    """Sum of all numbers before each one, block by block. ``x`` is used often, so it has to be a plain column."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(x) - 1) / BLOCK).cast("int")), lambda b: F.slice(x, b * BLOCK + 1, F.lit(BLOCK)))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda a, v: a + v))
    all_ = F.flatten(F.zip_with(blocks, _before(sums), lambda b, s: F.transform(_before(b), lambda v: v + s)))
    return F.when(F.size(x) > 0, all_).otherwise(F.array().cast("array<bigint>"))


def _candidates(df: DataFrame, kinds: tuple[Kind, ...], text: str, hits: str, gaps: str) -> DataFrame:
    """``hits`` and ``gaps`` of a text column: per kind what matches, and what stands between."""
    none = F.array().cast("array<string>")
    found = []
    for k in kinds:
        all_ = F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))
        found.append((F.when(F.contains(F.col(text), F.lit(k.needs)), all_).otherwise(none) if k.needs else all_).alias(k.name))
    df = computed_once(df, hits, F.struct(*found))
    between = [F.when(F.size(F.col(hits)[k.name]) > 0, F.split(text, k.pattern, -1)).otherwise(none).alias(k.name) for k in kinds]
    return computed_once(df, gaps, F.struct(*between))


def _scored(k: Kind, hit: Column, before: Column, after: Column) -> tuple[Column, Column]:
    """Whether a candidate counts, and its score."""
    score = F.lit(k.score)
    if k.cues:
        near = F.concat_ws(" ", F.right(before, F.lit(NEAR)), F.left(F.coalesce(after, F.lit("")), F.lit(NEAR)))
        score = score + F.when(near.rlike(rf"(?i)\b(?:{k.cues})\b"), F.lit(CUE_BONUS)).otherwise(F.lit(0.0))
    score = F.least(F.lit(1.0), score)
    good = k.check(hit)
    return (good if k.base else good & (score >= LEAST_SCORE)), score


def _span_of(k: Kind) -> Callable[[Column], Column]:
    """The span of a candidate ``h`` after the gap ``g``, before the gap ``n``, with ``s`` characters before both."""

    def span(r: Column) -> Column:
        ok, score = _scored(k, r["h"], r["g"], r["n"])
        start = r["s"] + F.length(r["g"])
        return F.struct(F.lit(k.name).alias("kind"), start.alias("start"), (start + F.length(r["h"])).alias("stop"), score.alias("score"), ok.alias("ok"))

    return span


def with_spans(df: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text", name: str = "spans") -> DataFrame:
    """``df`` with an array of ``kind, start, stop, score``, by kind as listed, then by start."""
    columns = [c for c in df.columns if c != name]
    # Helper columns take names that the input does not have.
    whole, hits, gaps, steps, found = (fresh(df, n) for n in ("_text", "_hits", "_gaps", "_steps", "_found"))
    own = _candidates(df.select(*columns, F.coalesce(text, F.lit("")).alias(whole)), kinds, whole, hits, gaps)
    lengths = [F.zip_with(F.col(gaps)[k.name], F.col(hits)[k.name], lambda g, h: (F.length(g) + F.coalesce(F.length(h), F.lit(0))).cast("bigint")).alias(k.name) for k in kinds]
    own = computed_once(own, steps, F.struct(*lengths))
    all_ = []
    for k in kinds:
        hit, gap = F.col(hits)[k.name], F.col(gaps)[k.name]
        rows = F.arrays_zip(hit.alias("h"), gap.alias("g"), F.slice(gap, F.lit(2), F.greatest(F.size(gap), F.lit(0))).alias("n"), running(F.col(steps)[k.name]).alias("s"))
        rows = F.filter(rows, lambda r: r["h"].isNotNull())

        all_.append(F.filter(F.transform(rows, _span_of(k)), lambda s: s["ok"]))
    spans = F.transform(F.concat(*all_), lambda s: s.dropFields("ok"))
    return computed_once(own, found, spans).select(*columns, F.col(found).alias(name))


def redact(df: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text") -> DataFrame:
    """``df`` with every span replaced by its kind in brackets; a null text stays null.

    Spans of several kinds that overlap are replaced as one, named after the kind listed first.
    """
    spans = fresh(df, "_spans")
    own = with_spans(df, kinds, text, spans)
    # Of spans in order of their start, each gives the stretch that no earlier one has covered.
    order = {k.name: n for n, k in enumerate(kinds)}
    rank = F.create_map(*(F.lit(x) for kv in order.items() for x in kv))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], rank[s["kind"]].alias("rank"), s["stop"], s["kind"])))
    own = computed_once(own, spans, ordered)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        kept = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        out = F.when(fresh, F.concat(acc["out"], F.array(kept, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(F.col(text))
    return own.withColumn(text, clean).select(*df.columns)


def span_text(spans: Column, base_only: bool = False) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    if base_only:
        spans = F.filter(spans, lambda s: s["kind"].isin(*(k.name for k in BASE)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
