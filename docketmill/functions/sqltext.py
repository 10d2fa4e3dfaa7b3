"""Literals for SQL expression text.

Rule tables hold hundreds of constants.  Written as SQL text they reach the JVM
in one call, where building them column by column takes thousands.
"""

from __future__ import annotations


def quoted(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double(value: float) -> str:
    return f"{float(value)!r}D"


def in_list(values) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"
