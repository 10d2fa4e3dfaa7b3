"""From page texts to documents, and the split into accepted and rejected ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketmill.functions.text import bind, strip_text

#: What identifies a document.
IDENTITY = ("source_bucket", "source_key")

MISSING = "missing input"
NO_TEXT = "no extractable text"


def latest_pages(pages: DataFrame, key: Sequence[str] = IDENTITY, arrival: str = "arrival") -> DataFrame:
    """Pages `(*key, page_no, page_text, arrival)` with one version of each numbered page: the last to arrive.

    Of versions that arrive at the same time the greatest text counts.  Versions are
    compared by tasks before they are shuffled, so a page that is written very often
    costs one row a task.  Pages without a number have no versions and all stay.
    """
    version = F.struct(arrival, "page_text")
    numbered = pages.filter("page_no is not null").groupBy(*key, "page_no").agg(F.max(version).alias("v")).select(
        *key, "page_no", F.col("v.page_text").alias("page_text"), F.col(f"v.{arrival}").alias(arrival))
    return numbered.unionByName(pages.filter("page_no is null").select(*key, "page_no", "page_text", arrival))


def assemble_pages(
    pages: DataFrame, key: Sequence[str] = IDENTITY, extractor: str = "pages", arrival: str = "arrival"
) -> DataFrame:
    """One row per document: `(*key, text, num_pages, char_count, extractor, error)`.

    Pages (`*key, page_no, page_text`) are joined in page order by a newline and
    the whole is stripped; a NULL page counts as an empty one.  Of several pages with
    one number the last counts by the column `arrival`, if there is one, then by text.
    Pages without a number follow the others in order of arrival and text, each of
    them: two equal ones are two pages.  The text of a document is one cell, so its
    pages must meet in one task; text is shuffled once and nothing else is read.
    Where pages are written again very often, take `latest_pages` first.
    """
    order = F.col(arrival) if arrival in pages.columns else F.lit(None).cast("int")
    text = F.coalesce("page_text", F.lit(""))
    numbered = F.when(F.col("page_no").isNotNull(), F.struct("page_no", order.alias("at"), text.alias("page_text")))
    others = F.when(F.col("page_no").isNull(), F.struct(order.alias("at"), text.alias("page_text")))

    def last_versions(versions: Column) -> Column:
        return F.filter(versions, lambda p, i: F.coalesce(
            F.get(versions, i + 1)["page_no"] != p["page_no"], F.lit(True)))

    docs = pages.groupBy(*key).agg(
        F.array_sort(F.collect_set(numbered)).alias("_numbered"), F.array_sort(F.collect_list(others)).alias("_others"),
    ).withColumn("_numbered", bind(F.col("_numbered"), last_versions)).select(
        *key,
        F.array_join(F.concat(F.col("_numbered.page_text"), F.col("_others.page_text")), "\n").alias("text"),
        (F.size("_numbered") + F.size("_others")).alias("num_pages"),
    ).withColumn("text", strip_text(F.col("text")))
    return docs.select(
        *key,
        "text",
        "num_pages",
        F.length("text").cast("bigint").alias("char_count"),
        F.lit(extractor).alias("extractor"),
        F.when(F.col("text") == "", F.lit(NO_TEXT)).alias("error"),
    )


def from_text(docs: DataFrame, text: str = "text", extractor: str = "text") -> DataFrame:
    """Whole texts as one-page documents with the columns of `assemble_pages`."""
    return docs.withColumns({
        text: strip_text(F.col(text)),
        "num_pages": F.lit(1),
        "extractor": F.lit(extractor),
    }).withColumns({
        "char_count": F.length(text).cast("bigint"),
        "error": F.when(F.coalesce(F.col(text) == "", F.lit(True)), F.lit(NO_TEXT)),
    })


def missing_inputs(manifest: DataFrame, pages: DataFrame, key: Sequence[str] = IDENTITY) -> DataFrame:
    """Manifest rows without a single page.

    Page keys are made distinct before the join, so a document with very many
    pages is one row by then.
    """
    return manifest.join(pages.select(*key).distinct(), list(key), "left_anti")


def accepted(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("error").isNull())


def quarantined(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("error").isNotNull())
