"""JSON cells as text, with keys in the order given and `", "` / `": "` between parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def string(value: Column) -> Column:
    """A quoted and escaped JSON string, or `null`."""
    return F.btrim(F.to_json(F.array(value)), F.lit("[]"))


def number(value: Column) -> Column:
    """A double in positional notation below 1e16, otherwise as `1.5e+16`, or `null`."""
    plain = value.cast("string")  # positional in this range
    digits = F.rtrim(value.try_cast("decimal(38,18)").cast("string"), F.lit("0"))
    positional = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    scientific = F.replace(F.replace(plain, F.lit(".0E"), F.lit("E")), F.lit("E"), F.lit("e+"))
    return (
        F.when(value.isNull(), F.lit("null"))
        .when((value == 0) | ((value >= 1e-3) & (value < 1e7)), plain)
        .when(F.abs(value) < 1e16, positional)
        .otherwise(scientific)
    )


def array(parts: Column) -> Column:
    """`[a, b]` from an array of JSON texts."""
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def entry(key: Column, value: Column) -> Column:
    """`"key": value` for a key without characters that need escaping."""
    return F.concat(F.lit('"'), key, F.lit('": '), value)


def object_of(entries: Column) -> Column:
    """`{...}` from an array of `entry` texts."""
    return F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))


def record(pairs: list[tuple[str, Column]]) -> Column:
    """An object with a fixed key list from JSON texts."""
    parts = []
    for i, (key, value) in enumerate(pairs):
        parts += [F.lit(("{" if i == 0 else ", ") + f'"{key}": '), value]
    return F.concat(*parts, F.lit("}"))
