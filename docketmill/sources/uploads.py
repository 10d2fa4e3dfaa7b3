"""Upload notifications, object manifests and page tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketmill.operators.rows import elements

EVENT_SCHEMA = (
    "struct<_corrupt_record: string, Records: array<struct<eventTime: string, s3: struct<"
    "bucket: struct<name: string>, object: struct<key: string>>>>>"
)
PAGE_SCHEMA = "source_bucket string, source_key string, page_no int, page_text string"
BROKEN = "unreadable notification"
NO_OBJECT = "notification without bucket or key"
ANY_CASE_PDF = "*.[pP][dD][fF]"


def decode_key(key: Column) -> Column:
    """URL-decoded object key, `+` being a space.

    A stray `%` that starts no escape is first written as `%25`, so good escapes
    in the same key are still decoded.
    """
    safe = F.regexp_replace(key, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), key)


def is_pdf(key: Column) -> Column:
    return F.endswith(F.lower(key), F.lit(".pdf"))


def unnest_events(events: DataFrame, body: str = "body") -> DataFrame:
    """One row per record of each JSON notification, with its key decoded.

    Notifications without records give no rows.  `accepted` tells documents from
    other objects, which are neither processed nor reported as failed; see
    `unreadable_events` for what cannot be parsed.
    """
    records = elements(events, [], F.from_json(body, EVENT_SCHEMA)["Records"], "r")
    decoded = records.select(
        F.col("r.eventTime").alias("event_time"),
        F.col("r.s3.bucket.name").alias("source_bucket"),
        decode_key(F.col("r.s3.object.key")).alias("source_key"),
    )
    return decoded.withColumn("accepted", F.coalesce(is_pdf(F.col("source_key")), F.lit(False)))


def unreadable_events(events: DataFrame, body: str = "body") -> DataFrame:
    """Notifications that name no object: `(body, error)`.

    A body that is no JSON object, or holds a record without a bucket or key, is
    reported once, as it is.
    """
    parsed = F.from_json(body, EVENT_SCHEMA)
    nameless = F.exists(
        parsed["Records"], lambda r: r["s3"]["bucket"]["name"].isNull() | r["s3"]["object"]["key"].isNull())
    reason = (
        F.when(F.col("p._corrupt_record").isNotNull() | F.col("p").isNull(), F.lit(BROKEN))
        .when(F.col("nameless"), F.lit(NO_OBJECT)))
    found = events.select(F.col(body).alias("body"), parsed.alias("p"), nameless.alias("nameless"))
    return found.select("body", reason.alias("error")).filter("error is not null").distinct()


def pdf_uploads(events: DataFrame, body: str = "body") -> DataFrame:
    """Distinct `(source_bucket, source_key)` of uploaded documents; a repeated
    notification counts once, and one without a bucket names no document
    (`unreadable_events` reports it)."""
    rows = unnest_events(events, body).filter("accepted and source_bucket is not null")
    return rows.select("source_bucket", "source_key").distinct()


def object_key(path: Column, root: str) -> Column:
    """Key of the object at `path` in the bucket whose top is `root`; both may be URIs."""
    top = re.sub("^[a-zA-Z0-9]+://[^/]*|^[a-zA-Z0-9]+:(?=/)", "", root).strip("/")
    inside = F.regexp_replace(F.regexp_replace(path, "^[a-zA-Z0-9]+://[^/]*|^[a-zA-Z0-9]+:(?=/)", ""), "^/+", "")
    return F.when(F.startswith(inside, F.lit(f"{top}/")), F.substring(inside, len(top) + 2, 1 << 30)).otherwise(
        inside) if top else inside


def read_manifest(spark: SparkSession, path: str, bucket: str = "", root: str | None = None) -> DataFrame:
    """Objects under `path` with a `.pdf` suffix in any case; their bytes are never read.

    `root` is the top of the bucket (`path` itself, if not given); keys are
    relative to it, as those of notifications are.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", ANY_CASE_PDF).option(
        "recursiveFileLookup", "true").load(path)
    return manifest_rows(files, bucket, path if root is None else root)


def manifest_rows(files: DataFrame, bucket: str, root: str) -> DataFrame:
    return files.select(
        F.lit(bucket).alias("source_bucket"),
        object_key(decode_key(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), root).alias("source_key"),
        "length",
        F.col("modificationTime").alias("modification_time"),
    )


def manifest_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """`(source_bucket, source_key, change)` of the objects that are `added`, `changed` or `gone` between two manifests.

    An object has changed if its length or its time has.  Objects are reduced to one
    row before the outer join on bucket and key, so a manifest may list one often.
    """
    key = ("source_bucket", "source_key")

    def listed(manifest: DataFrame, name: str) -> DataFrame:
        return manifest.groupBy(*key).agg(F.max(F.struct("modification_time", "length")).alias(name))

    both = listed(before, "_before").join(listed(after, "_after"), list(key), "full_outer")
    change = (
        F.when(F.col("_before").isNull(), F.lit("added"))
        .when(F.col("_after").isNull(), F.lit("gone"))
        .when(~F.col("_before").eqNullSafe(F.col("_after")), F.lit("changed")))
    return both.select(*key, change.alias("change")).filter("change is not null")


def mark_gone(records: DataFrame, changes: DataFrame) -> DataFrame:
    """`records` with `gone`: whether their object is no longer there."""
    gone = changes.filter("change = 'gone'").select("source_bucket", "source_key", F.lit(True).alias("gone"))
    return records.join(gone, ["source_bucket", "source_key"], "left").withColumn(
        "gone", F.coalesce("gone", F.lit(False)))


def with_arrival(pages: DataFrame) -> DataFrame:
    """Pages read from files, with `arrival`: when their file was written."""
    return pages.withColumn("arrival", F.col("_metadata.file_modification_time"))


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A page table `(source_bucket, source_key, page_no, page_text, arrival)` in Parquet, ORC, JSON or CSV."""
    reader = spark.read.schema(PAGE_SCHEMA)
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=True, escape='"')
    return with_arrival(reader.format(fmt).load(path))


def basename(key: Column) -> Column:
    return F.substring_index(key, "/", -1)


def uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)
