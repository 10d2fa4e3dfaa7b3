"""Category-specific fields: one expression per field over the document text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketmill.functions import jsontext
from docketmill.functions.text import bind, first_email, first_group, is_ascii, none_if_empty, regex, strip, to_number
from docketmill.rules import DOLLAR_AMOUNT, EMAIL


def largest_dollar_amount(text: Column) -> Column:
    def amounts_by(ascii_only: bool) -> Column:
        form = regex(DOLLAR_AMOUNT, ignore_case=False, ascii_only=ascii_only)
        return F.regexp_extract_all(text, F.lit(form), F.lit(0))

    amounts = F.when(is_ascii(text), amounts_by(True)).otherwise(amounts_by(False))
    return F.array_max(F.transform(amounts, to_number))


def currency(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("$")), F.lit("USD"))


def first_line(value: Column) -> Column:
    return none_if_empty(strip(F.substring_index(value, "\n", 1)))


def field_value(text: Column, kind: str, pattern: str | None) -> Column:
    if kind == "email":
        return first_email(text, EMAIL)
    if kind == "dollar_sign":
        return currency(text)
    found = first_group(text, pattern)
    if kind == "text":
        return found
    if kind == "text_or_null":
        return none_if_empty(found)
    if kind == "first_line":
        return first_line(found)
    if kind == "money":
        return to_number(found)
    if kind == "largest_money":
        return bind(found, lambda f: F.when(f != "", to_number(f)).otherwise(largest_dollar_amount(text)))
    raise ValueError(f"unknown field kind {kind!r}")


def is_number(kind: str) -> bool:
    return kind in ("money", "largest_money")


def fields_struct(text: Column, fields: list[tuple[str, str, str | None]]) -> Column:
    return F.struct(*[field_value(text, kind, pattern).alias(name) for name, kind, pattern in fields])


def fields_json(values: Column, fields: list[tuple[str, str, str | None]]) -> Column:
    return jsontext.record([
        (name, jsontext.number(values[name]) if is_number(kind) else jsontext.string(values[name]))
        for name, kind, _ in fields
    ])
