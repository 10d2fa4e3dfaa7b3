"""Label/value lines: which canonical field a line names and what its value is.

Most labels hold no `(`, `:` or `-`, so a line names one exactly when its text
before the first of these, with spaces collapsed and case folded, equals the
label.  One lookup per line therefore replaces one search per label and line.  A
label that holds such a sign is found by looking up the beginnings of the line of
every length that such labels have; there are as many lookups as lengths, however
many labels.  A line that names several labels gives a hit for each of them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docketmill.functions.sqltext import quoted
from docketmill.functions.text import (
    bind, collapse_inline_spaces, first_email, first_phone, fold_case, lines, regex, runs, to_number, trim_value,
)
from docketmill.rules import EMAIL, PHONE, VALUE_MONEY, RuleSet

LABEL_PART = r"^[^(:\-]*"
INLINE_VALUE = r"^(?:\([^)]*\))?\s*[:\-](.+)$"
NO_VALUE = r"^(?:\([^)]*\))?\s*[:\-]?\s*$"
# What may follow a label that was cut off at its length.
AFTER_LABEL = r"^(?![A-Za-z0-9])\s*"


def _has_sign(label: str) -> bool:
    return bool(re.search(r"[(:\-]", label))


def label_lines(text: Column, labels: Column, names: list[str]) -> Column:
    """`(line_no, label, alias, raw_value)` of the lines of a text that name a key of `labels`, of which none holds a sign."""
    return labelled(lines(text), names, labels)


def labelled(all_lines: Column, names: list[str], plain: Column | None, signed: Column | None = None) -> Column:
    """`(line_no, label, alias, raw_value)` of the lines of an array that name a key of `plain` or of `signed`.

    `names` are those keys, the ones that hold a sign being in `signed`.  The value follows
    the label on its line; only a label that stands alone takes the next line instead,
    which may itself be a label.  Spaces are collapsed and case is folded in all lines
    at once, so a line that names nothing costs a set test for each of its beginnings.
    """
    unsigned = [n for n in names if not _has_sign(n)]
    lengths = sorted({len(n) for n in names if _has_sign(n)})

    def cuts(line: Column, number: Column) -> Column:
        def cut(n: int) -> Column:
            label = F.substring(line, 1, n)
            return F.when(label.isin([name for name in names if _has_sign(name) and len(name) == n]), F.struct(
                number.alias("line_no"), label.alias("label")))

        return F.array_compact(F.array(*[cut(n) for n in lengths]))

    def with_value(found: Column, alias: Column, rest: Column, every: Column) -> Column:
        def valued(rest: Column) -> Column:
            # Without a bracket before it the sign comes first, and all that follows is the value.
            inline = F.when(F.substring(rest, 1, 1).isin(":", "-"), F.substr(rest, F.lit(2))).otherwise(
                F.regexp_extract(rest, regex(INLINE_VALUE), 1))
            value = bind(inline, lambda v: F.when(v != "", trim_value(v)).when(
                F.rlike(rest, F.lit(regex(NO_VALUE))), trim_value(F.get(every, found["line_no"] + 1))))
            return F.struct(
                found["line_no"].alias("line_no"), found["label"].alias("label"),
                alias.alias("alias"), value.alias("raw_value"))

        return bind(rest, valued)

    def of_heads(folded: Column, every: Column) -> Column:
        def rest(found: Column) -> Column:
            return F.regexp_replace(F.get(every, found["line_no"]), LABEL_PART, "")

        heads = F.transform(
            F.split(F.replace(F.replace(folded, F.lit("("), F.lit(":")), F.lit("-"), F.lit(":")), "\n"),
            lambda line, i: F.struct(i.alias("line_no"), F.btrim(F.substring_index(line, ":", 1)).alias("label")))
        return F.transform(F.filter(heads, lambda x: x["label"].isin(unsigned)), lambda x: with_value(
            x, plain[x["label"]], rest(x), every))

    def of_lengths(folded: Column, every: Column) -> Column:
        def rest(found: Column) -> Column:
            return F.substr(F.ltrim(F.get(every, found["line_no"])), F.length(found["label"]) + 1)

        found = F.flatten(F.transform(F.split(folded, "\n"), lambda line, i: cuts(F.ltrim(line), i)))
        whole = F.filter(found, lambda x: F.rlike(rest(x), F.lit(regex(AFTER_LABEL))))
        return F.transform(whole, lambda x: with_value(
            x, signed[x["label"]], F.regexp_replace(rest(x), regex(AFTER_LABEL), ""), every))

    def scan(flat: Column) -> Column:
        def of_lines(every: Column) -> Column:
            tried = [of_heads(fold_case(flat), every)] if plain is not None else []
            tried += [of_lengths(fold_case(flat), every)] if signed is not None else []
            return F.filter(F.concat(*tried), lambda x: x["raw_value"].isNotNull())

        return bind(F.split(flat, "\n"), of_lines)

    return bind(collapse_inline_spaces(F.array_join(all_lines, "\n")), scan)


def _without_sign(label: str) -> bool:
    return not _has_sign(label)


def alias_map(rules: RuleSet, chosen=lambda label: True) -> Column | None:
    """Literal map from the chosen labels to their field, orders and kind; None if there are none."""
    entries = ", ".join(
        f"{quoted(alias)}, named_struct('field', {quoted(name)}, 'field_ord', {f_ord},"
        f" 'alias_ord', {a_ord}, 'kind', {quoted(kind)})"
        for name, f_ord, alias, a_ord, kind in rules.alias_rows if chosen(alias)
    )
    return F.expr(f"map({entries})") if entries else None


def normalized_text(raw: Column, kind: Column) -> Column:
    return F.when(
        kind == "email", F.coalesce(first_email(raw, EMAIL), raw)
    ).when(
        kind == "phone", F.coalesce(first_phone(raw, PHONE), raw)
    ).when(kind == "text", raw)


def normalized_number(raw: Column, kind: Column) -> Column:
    first = F.regexp_substr(raw, F.lit(regex(VALUE_MONEY, ignore_case=False)))
    return F.when(kind == "money", to_number(first))


def line_hits(all_lines: Column, rules: RuleSet) -> Column:
    """Hits `(field_ord, alias_ord, raw_value, line_no, field, matched_label, kind, text_value, number_value)`
    of an array of lines; those without a normalised value are dropped."""

    def resolve(line: Column) -> Column:
        a = line["alias"]
        return F.struct(
            a["field_ord"].alias("field_ord"),
            a["alias_ord"].alias("alias_ord"),
            line["raw_value"].alias("raw_value"),
            line["line_no"].alias("line_no"),
            a["field"].alias("field"),
            line["label"].alias("matched_label"),
            a["kind"].alias("kind"),
            normalized_text(line["raw_value"], a["kind"]).alias("text_value"),
            normalized_number(line["raw_value"], a["kind"]).alias("number_value"),
        )

    names = [r[2] for r in rules.alias_rows]
    found = labelled(all_lines, names, alias_map(rules, _without_sign), alias_map(rules, _has_sign))
    hits = F.transform(found, resolve)
    return F.filter(hits, lambda h: h["text_value"].isNotNull() | h["number_value"].isNotNull())


def evidence(text: Column, rules: RuleSet) -> Column:
    """All field evidence of a document, in field, label, line order.

    Equal evidence is kept once, where it occurs first; evidence without a
    normalised value is dropped.
    """
    def distinct(hits: Column) -> Column:
        def first_of_run(h: Column, i: Column) -> Column:
            before = F.get(hits, i - 1)
            return (i == 0) | (h["field_ord"] != before["field_ord"]) | (
                h["alias_ord"] != before["alias_ord"]) | (h["raw_value"] != before["raw_value"])

        kept = F.filter(hits, first_of_run)
        return F.sort_array(F.transform(kept, lambda h: F.struct(
            h["field_ord"].alias("field_ord"), h["alias_ord"].alias("alias_ord"),
            h["line_no"].alias("line_no"), h["field"].alias("field"),
            h["matched_label"].alias("matched_label"), h["raw_value"].alias("raw_value"),
            h["kind"].alias("kind"), h["text_value"].alias("text_value"),
            h["number_value"].alias("number_value"),
        )))

    return bind(F.sort_array(line_hits(lines(text), rules)), distinct)


def by_field(evidence_list: Column) -> Column:
    """`(field, hits)` groups of ordered evidence, in field order."""

    def group(ev: Column) -> Column:
        fields = runs(F.transform(ev, lambda e: e["field"]))
        return F.transform(fields, lambda r: F.struct(
            r["item"].alias("field"), F.slice(ev, r["pos"], r["cnt"]).alias("hits")))

    return bind(evidence_list, group)
