"""Output records: 21 columns, one row per processed document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketmill.functions import jsontext
from docketmill.operators.classify import SCORE_KINDS
from docketmill.rules import DEFAULT_RULES, RuleSet, column_name
from docketmill.sources.uploads import basename, uri

# The columns of a record in CSV order.
CSV_COLUMNS = [
    "document_id",
    "filename",
    "source_bucket",
    "source_key",
    "source_path",
    "s3_uri",
    "category",
    "best_category_match",
    "confidence",
    "num_pages",
    "char_count",
    "extractor",
    "summary",
    "metadata",
    "keyword_fields",
    "keyword_matches",
    "category_scores",
    "category_alias_scores",
    "category_tfidf_scores",
    "category_structural_scores",
    "processed_at",
]
# The keys of a JSON record in order.
JSON_KEYS = [
    "document_id",
    "filename",
    "source_bucket",
    "source_key",
    "s3_uri",
    "category",
    "best_category_match",
    "confidence",
    "category_scores",
    "category_alias_scores",
    "category_tfidf_scores",
    "category_structural_scores",
    "num_pages",
    "char_count",
    "extractor",
    "summary",
    "metadata",
    "keyword_fields",
    "keyword_matches",
    "processed_at",
]
REJECT_COLUMNS = [
    "filename", "source_bucket", "source_key", "source_path", "s3_uri", "num_pages", "extractor", "error",
]
# Columns of a record that already hold JSON text, and those that are numbers.
JSON_CELLS = {
    "metadata", "keyword_fields", "keyword_matches",
    "category_scores", "category_alias_scores", "category_tfidf_scores", "category_structural_scores",
}
INTEGERS = {"num_pages", "char_count"}


def document_id(location: Column, text: Column) -> Column:
    """An id in UUID form that depends on where the document is and what it says.

    Recomputing a lost task or receiving a notification twice gives the same id;
    a changed file under the same name gives another one.
    """
    digest = F.sha2(F.concat_ws("\n", location, F.md5(text)), 256)
    return F.concat_ws("-", *[F.substring(digest, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def score_cell(scores: Column, rules: RuleSet) -> Column:
    return jsontext.record([(c, jsontext.number(scores[column_name(c)])) for c in rules.categories])


def utc_seconds(ts: Column) -> Column:
    return F.concat(F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss"),
                    F.lit("+00:00"))


def to_record(tagged: DataFrame, rules: RuleSet = DEFAULT_RULES) -> DataFrame:
    """Tagged documents as records; nested cells are JSON text in their fixed order.

    `error` is kept behind the record columns: NULL for a processed document.
    """
    cols = tagged.columns

    def given(name: str) -> Column:
        return F.col(name) if name in cols else F.lit(None).cast("string")

    location = F.coalesce(uri(given("source_bucket"), given("source_key")), given("source_path"), given("source_key"))
    cells = {
        ("category_" + kind if kind != "scores" else "category_scores"): score_cell(F.col(kind), rules)
        for kind in SCORE_KINDS
    }
    values = {
        "document_id": document_id(location, F.col("text")),
        "filename": basename(F.coalesce(given("source_key"), given("source_path"))),
        "source_bucket": given("source_bucket"),
        "source_key": given("source_key"),
        "source_path": given("source_path"),
        "s3_uri": uri(given("source_bucket"), given("source_key")),
        "best_category_match": F.col("best_match"),
        "processed_at": utc_seconds(F.current_timestamp()),
        **cells,
    }
    return tagged.select(*[
        (values[name] if name in values else F.col(name)).alias(name) for name in CSV_COLUMNS
    ], given("error").alias("error"))


def json_lines(records: DataFrame) -> DataFrame:
    """Records as one JSON object per row, keys in record order, NULL as `null`.

    `source_path` is a key of local records only, where it replaces the three
    location keys.
    """

    def cell(name: str) -> Column:
        if name in JSON_CELLS:
            return F.col(name)
        if name in INTEGERS:
            return F.coalesce(F.col(name).cast("string"), F.lit("null"))
        if name == "confidence":
            return jsontext.number(F.col(name))
        return jsontext.string(F.col(name))

    local_keys = ["source_path" if k == "source_bucket" else k for k in JSON_KEYS if k not in ("source_key", "s3_uri")]
    uploaded = jsontext.record([(k, cell(k)) for k in JSON_KEYS])
    local = jsontext.record([(k, cell(k)) for k in local_keys])
    return records.select(
        "document_id",
        "source_key",
        F.when(F.col("source_path").isNotNull() & F.col("s3_uri").isNull(), local).otherwise(uploaded).alias("value"),
    )


def csv_rows(records: DataFrame) -> DataFrame:
    """Records as text columns in CSV order; missing values are empty."""

    def cell(name: str) -> Column:
        value = jsontext.number(F.col(name)) if name == "confidence" else F.col(name).cast("string")
        return F.coalesce(value, F.lit("")).alias(name)

    return records.select(*[cell(name) for name in CSV_COLUMNS])
