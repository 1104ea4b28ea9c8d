"""Time arithmetic and the normalisation of mixed timestamp spellings.

Everything works on TIMESTAMP_NTZ wall-clock values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from millrace.functions import variants as V
from millrace.functions.sqltext import let, literal
from millrace.functions.text import WS_CLASS

NTZ = "timestamp_ntz"

# Fixed value: the normal output form.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Fixed value: a number above this is an epoch in milliseconds, else in seconds.
MILLIS_ABOVE = 32503680000

# Years 1 to 9999 in epoch seconds, the range a timestamp may have.
EPOCH_MIN, EPOCH_END = -62135596800, 253402300800

# Accepted spellings, as whole-text patterns over named parts. One-digit month, day, hour, minute
# and second are allowed, as is a blank in place of the leading zero of a day.
_Y = r"(?!0000)\d{4}"
_M = r"(?:1[0-2]|0?[1-9])"
_D = r"(?:3[01]|[12]\d|0?[1-9])"
_DAY_BLANK = r"(?: (?=[1-9](?!\d)))?"
_CLOCK = r"(?:2[0-3]|[01]?\d):[0-5]?\d:[0-5]?\d"
_FRACTION = r"(?:\.\d{1,6})?"
_OFFSET = (
    r"[+-](?:[01]\d|2[0-3])"
    r"(?::[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?|[0-5]\d(?:[0-5]\d(?:\.\d{1,6})?)?)"
)
_GAP = f"[{WS_CLASS}]+"

ISO_FORM = (
    rf"^({_Y}-{_M}-){_DAY_BLANK}({_D})"
    rf"(?:[Tt]({_CLOCK}{_FRACTION})(?:[Zz]|({_OFFSET}))|{_GAP}({_CLOCK}{_FRACTION}))?\z"
)
DAY_FIRST_FORM = rf"^{_DAY_BLANK}({_D})/({_M})/({_Y}){_GAP}({_CLOCK})\z"
MONTH_FIRST_FORM = rf"^({_M})/{_DAY_BLANK}({_D})/({_Y}){_GAP}({_CLOCK})\z"

# (pattern, rearrangement into a text that casts to a timestamp), tried in this order, so a date
# such as 05/01/2024 is the fifth of January.
TEXT_FORMS = (
    (ISO_FORM, "$1$2 $3$5"),
    (DAY_FIRST_FORM, "$3-$2-$1 $4"),
    (MONTH_FIRST_FORM, "$3-$1-$2 $4"),
)


def as_of_column(as_of: Column | dt.datetime | str | None = None) -> Column:
    """The run's notion of now, as TIMESTAMP_NTZ; the session clock when not given."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of.cast(NTZ)
    return F.lit(str(as_of)).cast(NTZ)


def minus(ts: Column, *, days: int = 0, hours: int = 0, minutes: int = 0) -> Column:
    return ts - F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(minutes))


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """How many unit boundaries lie between two wall-clock times.

    10:59 to 11:01 crosses one hour boundary; ``timestampdiff`` would count 0 whole hours.
    """
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    hours = days * 24 + F.hour(end) - F.hour(start)
    minutes = hours * 60 + F.minute(end) - F.minute(start)
    return {"DAY": days, "HOUR": hours, "MINUTE": minutes}[unit.upper()]


def ts_from_text(x: str, to_utc: bool = False) -> str:
    """SQL text that parses the accepted spellings of a text; NULL where none fits.

    An offset is dropped and the wall clock kept, unless ``to_utc`` asks for conversion.
    """
    tries = [
        f"IF({x} RLIKE {literal(p)}, TRY_CAST(regexp_replace({x}, {literal(p)}, {literal(form)}) AS TIMESTAMP_NTZ), NULL)"
        for p, form in TEXT_FORMS
    ]
    parsed = f"coalesce({', '.join(tries)})"
    if not to_utc:
        return parsed
    offset = f"regexp_extract({x}, {literal(ISO_FORM)}, 4)"
    hours, minutes, seconds = (
        f"coalesce(TRY_CAST(substring(regexp_replace({offset}, '[+:-]', ''), {at}, 2) AS INT), 0)" for at in (1, 3, 5)
    )
    sign = f"IF({offset} LIKE '-%', -1, 1)"
    return f"{parsed} - make_dt_interval(0, 0, 0, {sign} * ({hours} * 3600 + {minutes} * 60 + {seconds}))"


def ts_from_epoch(x: str) -> str:
    """SQL text for an epoch in seconds, or milliseconds above the threshold; NULL outside years 1 to 9999."""
    seconds = f"IF(CAST({x} AS DOUBLE) > {MILLIS_ABOVE}D, CAST({x} AS DOUBLE) / 1000, CAST({x} AS DOUBLE))"
    micros = "CAST(floor(s) AS BIGINT) * 1000000 + CAST(rint((s - floor(s)) * 1e6) AS BIGINT)"
    in_range = f"s >= {EPOCH_MIN}D AND s < {EPOCH_END}D"
    return let("s", seconds, f"CAST(IF({in_range}, timestamp_micros({micros}), NULL) AS TIMESTAMP_NTZ)")


def format_ts(ts: Column, pattern: str = ISO_MICROS) -> Column:
    return F.date_format(ts, pattern)


def normalize_ts_sql(x: str, dtype: str = "string", pattern: str = ISO_MICROS, to_utc: bool = False) -> str:
    """`normalize_ts` as SQL text over the SQL text of a value."""
    if dtype == "string":
        parsed = ts_from_text(x, to_utc)
    elif dtype in ("timestamp", NTZ, "date"):
        parsed = f"CAST({x} AS TIMESTAMP_NTZ)"
    elif dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        parsed = ts_from_epoch(x)
    else:
        return "CAST(NULL AS STRING)"
    return f"date_format({parsed}, {literal(pattern)})"


def normalize_ts(x: str, dtype: str = "string", pattern: str = ISO_MICROS, to_utc: bool = False) -> Column:
    """One normal text for a typed timestamp column, named or given as SQL text.

    ``dtype`` is its Spark type name; booleans and nested values give NULL.
    """
    return F.expr(normalize_ts_sql(x, dtype, pattern, to_utc))


def normalize_ts_variant(v: str, kind: str, pattern: str = ISO_MICROS, to_utc: bool = False) -> str:
    """`normalize_ts` for the SQL texts of a VARIANT value and of its type (`variants.type_name`)."""
    text = let("t", f"try_variant_get({v}, '$', 'string')", ts_from_text("t", to_utc))
    number = ts_from_epoch(f"try_variant_get({v}, '$', 'double')")
    stamp = f"try_variant_get({v}, '$', '{NTZ}')"
    parsed = (
        f"CASE WHEN {V.is_text(kind)} THEN {text} WHEN {V.is_number(kind)} THEN {number}"
        f" WHEN {kind} LIKE 'TIMESTAMP%' OR {kind} = 'DATE' THEN {stamp} END"
    )
    return f"date_format({parsed}, {literal(pattern)})"


def ts_error(v: str) -> Column:
    """Why a present VARIANT value has no normal form; NULL when it has one, or is null itself."""
    lost = f"{normalize_ts_variant(v, 'k')} IS NULL"
    reason = (
        f"CASE WHEN {V.is_text('k')} AND {lost} THEN 'unknown timestamp spelling'"
        f" WHEN {V.is_number('k')} AND {lost} THEN 'epoch out of range'"
        f" WHEN {V.is_object('k')} OR {V.is_array('k')} OR k = 'BOOLEAN' THEN 'not a timestamp' END"
    )
    return F.expr(let("k", f"schema_of_variant({v})", reason))
