"""The whole run: documents in, records and rejects out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketmill.functions.text import is_blank
from docketmill.operators.classify import classify
from docketmill.operators.keywords import keyword_cells
from docketmill.operators.metadata import metadata
from docketmill.operators.pages import IDENTITY, MISSING, NO_TEXT, accepted, assemble_pages, from_text, quarantined
from docketmill.operators.summarize import summarize
from docketmill.plans import records as R
from docketmill.rules import DEFAULT_RULES, RuleSet
from docketmill.sources import sinks
from docketmill.sources.uploads import pdf_uploads, unreadable_events

def tag(documents: DataFrame, rules: RuleSet = DEFAULT_RULES, num_sentences: int = 3) -> DataFrame:
    """Add category, scores, metadata, label/value fields and a summary to each document.

    Each step reads only the row's own text, so the plan is one map-only stage:
    the text is read once and never shuffled.
    """
    df = classify(documents, rules)
    df = metadata(df, rules)
    df = keyword_cells(df, rules)
    return summarize(df, num_sentences, rules)


def outcomes(documents: DataFrame, rules: RuleSet = DEFAULT_RULES, num_sentences: int = 3) -> DataFrame:
    """Record columns plus `error` for every document, processed or not.

    A document that cannot be processed is a row with a reason, never a failed
    task, so one bad document does not stop the others.
    """
    docs = documents if "error" in documents.columns else documents.withColumn(
        "error", F.when(is_blank(F.col("text")), F.lit(NO_TEXT)))
    return R.to_record(tag(docs, rules, num_sentences), rules)


def records(documents: DataFrame, rules: RuleSet = DEFAULT_RULES, num_sentences: int = 3) -> DataFrame:
    """Records of the documents that have text; see `rejects` for the others."""
    docs = accepted(documents) if "error" in documents.columns else documents.filter(
        ~is_blank(F.col("text")))
    return outcomes(docs, rules, num_sentences).drop("error")


def rejects(documents: DataFrame) -> DataFrame:
    """Documents that could not be processed, with the reason."""
    return quarantined(documents)


def documents_for(uploads: DataFrame, pages: DataFrame) -> DataFrame:
    """Uploads joined to their assembled pages; an upload without pages gets an error.

    Only pages of uploaded documents are grouped, and what is grouped stays where
    it is for the join: the page table is read once and its text shuffled once.
    """
    wanted = pages.join(uploads.select(*IDENTITY).distinct(), list(IDENTITY), "left_semi")
    found = uploads.join(assemble_pages(wanted).withColumn("_found", F.lit(True)), list(IDENTITY), "left")
    return found.withColumn(
        "error", F.when(F.col("_found").isNull(), F.lit(MISSING)).otherwise(F.col("error"))
    ).drop("_found")


def run(
    documents: DataFrame,
    out_path: str | None = None,
    rules: RuleSet = DEFAULT_RULES,
    num_sentences: int = 3,
) -> tuple[DataFrame, DataFrame]:
    """Process documents and return `(records, rejects)`.

    With `out_path` the outcomes are computed once and written as Parquet; the CSV
    and JSON files, which are committed together, and the returned frames are made
    from that table.  Ids and
    times therefore agree everywhere, and a lost executor costs a re-read, not a
    second pass over the texts.  Without it nothing is written.
    """
    found = outcomes(documents, rules, num_sentences)
    if out_path is None:
        return accepted(found).select(*R.CSV_COLUMNS), quarantined(found).select(*R.REJECT_COLUMNS)
    sinks.write_outcomes(found, f"{out_path}/outcomes")
    done, bad = sinks.read_outcomes(documents.sparkSession, f"{out_path}/outcomes")
    sinks.write_results(done, f"{out_path}/results")
    return done, bad


def process_uploads(
    events: DataFrame, pages: DataFrame, out_path: str | None = None, rules: RuleSet = DEFAULT_RULES
) -> tuple[DataFrame, DataFrame]:
    """Notifications and page texts to `(records, rejects)`; unreadable notifications are rejects."""
    return run(with_unreadable(documents_for(pdf_uploads(events), pages), events), out_path, rules)


def with_unreadable(documents: DataFrame, events: DataFrame, body: str = "body") -> DataFrame:
    """Documents and, as rows with an error only, the notifications that name none."""
    bad = unreadable_events(events, body).select("error")
    return documents.unionByName(bad, allowMissingColumns=True)


def process_texts(
    spark: SparkSession, path: str, out_path: str | None = None, rules: RuleSet = DEFAULT_RULES
) -> tuple[DataFrame, DataFrame]:
    """Batch form for a folder of text files, one document each; keeps `source_path`."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("source_path"))
    return run(from_text(files), out_path, rules)
