"""Whitespace, key names and masking."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from millrace.functions.sqltext import literal

# The characters that count as whitespace at the ends of a text
# (tab to carriage return, the four separators, space, next line, and the Unicode spaces).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a regex class body.
WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Key clean-up, in order, as (pattern, replacement); lower-casing follows.
KEY_RULES = (
    (rf"[-{WS_CLASS}]+", "_"),
    (r"[^a-zA-Z0-9_]", ""),
    (r"([a-z0-9])([A-Z])", r"$1_$2"),
)
ACRONYM_RULE = (r"([A-Z]+)([A-Z][a-z])", r"$1_$2")

# Keys that the clean-up would leave as they are.
SNAKE_FORM = r"^[a-z0-9]+(?:_[a-z0-9]+)*\z"
# Keys in which only capitals can need handling.
PLAIN_FORM = r"^[a-zA-Z0-9]+\z"

# Address masking.
MASK_PATTERN, MASK_TEXT = r".+@", "***@"


def trim_sql(x: str) -> str:
    return f"btrim({x}, {literal(WHITESPACE)})"


def trim_ws(c: Column) -> Column:
    """Strip whitespace, Unicode spaces included, from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return trim_ws(c) == ""


def _rules(split_acronyms: bool):
    head, camel = KEY_RULES[:2], KEY_RULES[2]
    return (*head, ACRONYM_RULE, camel) if split_acronyms else (*head, camel)


def snake_sql(x: str, split_acronyms: bool = False) -> str:
    """`snake_key` as SQL text over the SQL text of a key.

    Matching is much cheaper than replacing, so keys that need no change, or only their capitals
    handled, skip the replacements that can not apply to them.
    """

    def replaced(text: str, rules) -> str:
        for pattern, replacement in rules:
            text = f"regexp_replace({text}, {literal(pattern)}, {literal(replacement)})"
        return f"lower({text})"

    rules = _rules(split_acronyms)
    capitals = replaced(x, rules[2:])
    full = f"btrim(regexp_replace({replaced(x, rules)}, '_+', '_'), '_')"
    return (
        f"CASE WHEN {x} RLIKE {literal(SNAKE_FORM)} THEN {x}"
        f" WHEN {x} RLIKE {literal(PLAIN_FORM)} THEN {capitals} ELSE {full} END"
    )


def snake_key(column: str, split_acronyms: bool = False) -> Column:
    """A column of key texts in snake_case: ``userName`` gives ``user_name``.

    ``someAPIKey`` gives ``some_apikey``, or ``some_api_key`` with ``split_acronyms``.
    """
    return F.expr(snake_sql(column, split_acronyms))


def snake_name(name: str, split_acronyms: bool = False) -> str:
    """`snake_key` for a column name known to the driver."""
    for pattern, replacement in _rules(split_acronyms):
        name = re.sub(pattern, replacement.replace("$", "\\"), name)
    return re.sub("_+", "_", name.lower()).strip("_")


def mask_email(c: Column, role: Column | str, masked_roles: tuple[str, ...] = ("ANALYST_ROLE",)) -> Column:
    """Hide the part before ``@`` from the given roles."""
    who = F.lit(role) if isinstance(role, str) else role
    return F.when(who.isin(*masked_roles), F.regexp_replace(c, MASK_PATTERN, MASK_TEXT)).otherwise(c)
