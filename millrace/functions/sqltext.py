"""SQL text for expressions that nest deeply.

A Column costs several driver-to-JVM calls per node, so an expression with thousands of nodes takes seconds to build;
the same expression as text is parsed in one call.
"""

from __future__ import annotations


def literal(text: str) -> str:
    """A string literal; everything but plain ASCII is escaped."""
    plain = "".join(c if " " <= c <= "~" and c not in "'\\" else f"\\u{ord(c):04x}" for c in text)
    return f"'{plain}'"


def name(column: str) -> str:
    """A quoted column or field name."""
    return "`" + column.replace("`", "``") + "`"


def any_of(value: str, options) -> str:
    return f"({value} IN ({', '.join(literal(o) for o in options)}))"


def let(var: str, value: str, body: str) -> str:
    """``body`` with ``var`` standing for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {var} -> {body}), 1)"
