"""Generic label/value fields with evidence, independent of the category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketmill.functions import jsontext
from docketmill.functions import labels as L
from docketmill.functions import text as T
from docketmill.operators.rows import elements
from docketmill.rules import DEFAULT_RULES, RuleSet


def lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per line: `(key, line_no, line, next_line)`, numbered from 0."""
    split = docs.select(key, T.lines(F.col(text)).alias("_lines"))
    pairs = T.bind(F.col("_lines"), lambda all_lines: F.transform(
        all_lines,
        lambda line, i: F.struct(line.alias("line"), F.get(all_lines, i + 1).alias("next_line"))))
    return elements(split, [key], pairs, "l", "line_no").select(key, "line_no", "l.line", "l.next_line")


def with_evidence(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add `evidence`, the ordered list of label/value hits of each document."""
    return docs.withColumn("evidence", L.evidence(F.col(text), rules))


def keyword_matches(
    docs: DataFrame, rules: RuleSet = DEFAULT_RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece of evidence, numbered in record order within its document."""
    found = with_evidence(docs.select(key, text), rules, text)
    return elements(found, [key], F.col("evidence"), "e", "match_no").select(
        key,
        "match_no",
        F.col("e.field").alias("field"),
        F.col("e.matched_label").alias("matched_label"),
        F.col("e.raw_value").alias("raw_value"),
        F.col("e.text_value").alias("text_value"),
        F.col("e.number_value").alias("number_value"),
        F.col("e.line_no").alias("line_no"),
    )


def _value_json(hit: Column) -> Column:
    return F.when(hit["kind"] == "money", jsontext.number(hit["number_value"])).otherwise(
        jsontext.string(hit["text_value"]))


def _field_json(values: Column) -> Column:
    return F.when(F.size(values) == 1, values[0]).otherwise(jsontext.array(values))


def _hit_json(hit: Column) -> Column:
    return jsontext.record([
        ("matched_label", jsontext.string(hit["matched_label"])),
        ("raw_value", jsontext.string(hit["raw_value"])),
        ("normalized_value", _value_json(hit)),
    ])


def _groups(docs: DataFrame, rules: RuleSet, text: str) -> DataFrame:
    """Add `_groups`: per field its name and the JSON texts of its values."""

    def encode(group: Column) -> Column:
        return F.struct(
            group["field"].alias("field"),
            F.transform(group["hits"], _value_json).alias("values"),
            F.transform(group["hits"], _hit_json).alias("hits"),
        )

    return with_evidence(docs, rules, text).withColumn(
        "_groups", F.transform(L.by_field(F.col("evidence")), encode))


def keyword_fields(
    docs: DataFrame, rules: RuleSet = DEFAULT_RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document and field; `value` is the JSON scalar, or list for several hits."""
    grouped = _groups(docs.select(key, text), rules, text)
    return elements(grouped, [key], F.col("_groups"), "g").select(
        key,
        F.col("g.field").alias("field"),
        F.size("g.values").alias("hits"),
        _field_json(F.col("g.values")).alias("value"),
    )


def keyword_cells(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    """Add the JSON cells `keyword_fields` and `keyword_matches` of each document."""
    df = _groups(docs, rules, text)
    return df.withColumns({
        "keyword_fields": jsontext.object_of(F.transform(
            "_groups", lambda g: jsontext.entry(g["field"], _field_json(g["values"])))),
        "keyword_matches": jsontext.object_of(F.transform(
            "_groups", lambda g: jsontext.entry(g["field"], jsontext.array(g["hits"])))),
    }).drop("_groups")
