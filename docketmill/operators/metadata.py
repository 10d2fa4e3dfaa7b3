"""Category-specific metadata: typed structs and the JSON cell of a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketmill.functions import extraction as X
from docketmill.functions import jsontext
from docketmill.rules import DEFAULT_RULES, RuleSet, column_name


def category_metadata(
    docs: DataFrame, category: str, rules: RuleSet = DEFAULT_RULES, text: str = "text"
) -> DataFrame:
    """Add the fields of one category to every row, whatever the row's category."""
    fields = rules.category_fields[category]
    return docs.withColumns({
        name: X.field_value(F.col(text), kind, pattern) for name, kind, pattern in fields
    })


def invoice_metadata(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    return category_metadata(docs, "Invoice", rules, text)


def sales_report_metadata(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    return category_metadata(docs, "Sales Report", rules, text)


def application_metadata(docs: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text") -> DataFrame:
    return category_metadata(docs, "Customer Application", rules, text)


def _missing_extractor(category: Column) -> Column:
    message = F.concat(F.lit("No extractor registered for category '"), category, F.lit("'."))
    return jsontext.record([("warning", jsontext.string(message))])


def metadata(
    classified: DataFrame, rules: RuleSet = DEFAULT_RULES, text: str = "text", category: str = "category"
) -> DataFrame:
    """Add one struct per category and `metadata`, the JSON of the matching one.

    Only the struct of the row's own category is computed; the others are NULL.
    A category without fields gets a warning object.
    """
    structs = {
        f"{column_name(c)}_fields": F.when(F.col(category) == c, X.fields_struct(F.col(text), fields))
        for c, fields in rules.category_fields.items()
    }
    df = classified.withColumns(structs)
    cell = F.lit(None).cast("string")
    for c, fields in rules.category_fields.items():
        values = F.col(f"{column_name(c)}_fields")
        cell = F.when(F.col(category) == c, X.fields_json(values, fields)).otherwise(cell)
    return df.withColumn("metadata", F.coalesce(cell, _missing_extractor(F.col(category))))
