"""Arrival-driven runs: new files are processed as they land.

A micro-batch is the batch pipeline applied to the files that arrived.  What was
done before is looked up in a log of the written outcomes' keys, of which a batch
reads only the buckets of its own documents (`keylog`); no state store is needed,
and nothing is forgotten after a while.
"""

from __future__ import annotations

import hashlib
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docketmill.operators.pages import IDENTITY
from docketmill.plans.pipeline import documents_for, outcomes, with_unreadable
from docketmill.plans.records import CSV_COLUMNS, REJECT_COLUMNS
from docketmill.rules import DEFAULT_RULES, RuleSet
from docketmill.session import checkpoint_root
from docketmill.sources import sinks
from docketmill.sources.files import StoredPath
from docketmill.sources.uploads import (
    ANY_CASE_PDF, PAGE_SCHEMA, is_pdf, manifest_rows, pdf_uploads, read_pages, with_arrival)
from docketmill.streaming.keylog import KeyLog


def _parts(path: str) -> tuple[str, str, list[str]]:
    url = urlparse(path)
    scheme = "" if url.scheme == "file" else url.scheme
    return scheme, url.netloc, [p for p in url.path.split("/") if p]


def assert_no_loop(in_path: str, out_path: str) -> None:
    """Refuse to write results where the stream would read them again."""
    (s1, h1, source), (s2, h2, target) = _parts(in_path), _parts(out_path)
    if (s1, h1) == (s2, h2) and target[: len(source)] == source:
        raise ValueError(f"output {out_path} lies inside input {in_path}")


def stable_name(*paths: str) -> str:
    """A folder name that is the same for the same paths in every process."""
    return hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]


def page_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Page files as they arrive: `(source_bucket, source_key, page_no, page_text, arrival)`."""
    reader = spark.readStream.schema(PAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return with_arrival(reader.format(fmt).load(path))


def upload_stream(
    spark: SparkSession, path: str, bucket: str = "", root: str | None = None, files_per_trigger: int | None = None
) -> DataFrame:
    """New `.pdf` objects under `path` as manifest rows; their bytes are not read."""
    reader = spark.readStream.format("binaryFile").option("pathGlobFilter", ANY_CASE_PDF).option(
        "recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return manifest_rows(reader.load(path), bucket, path if root is None else root)


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON notification files as they arrive, one `body` each."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path, wholetext=True).withColumnRenamed("value", "body")


#: What documents are counted by: the category of a record, or the error of a reject.
_STATUS = ("category", "error")
_OUTCOMES = f"{sinks.RECORD_SCHEMA}, error string, rejected boolean, batch_id bigint"


def _written(spark: SparkSession, out_path: str, batch_id: int | None = None) -> DataFrame:
    """Outcomes of one batch, or of all; none if nothing is written yet.

    The folder of a batch is read by its name, without listing the others.
    """
    top = f"{out_path}/outcomes"
    try:
        return spark.read.schema(_OUTCOMES).option("basePath", top).parquet(
            top if batch_id is None else f"{top}/batch_id={batch_id}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _OUTCOMES)


def key_log(spark: SparkSession, out_path: str) -> KeyLog:
    """The log of the documents that the batches under `out_path` have outcomes of."""

    def keys(batch_id: int) -> DataFrame:
        rows = _written(spark, out_path, batch_id).filter("source_key is not null")
        return rows.select(*IDENTITY, "batch_id", (~F.col("rejected")).alias("has_record"), *_STATUS)

    return KeyLog(spark, f"{out_path}/keys", keys, more="category string, error string")


def _counted(outcomes: DataFrame, sign: int) -> DataFrame:
    status = [F.when(F.col("error").isNull(), F.col("category")).alias("category"), F.col("error")]
    return outcomes.select(*status).groupBy(*_STATUS).agg((F.count(F.lit(1)) * sign).alias("documents"))


def _write_totals(spark: SparkSession, out_path: str, batch_id: int) -> None:
    """Totals up to a batch, from those up to the one before and what the batch has changed.

    A document with an earlier outcome is taken off where it was counted.  A retried
    batch starts from the same totals and writes the same.
    """
    new = _written(spark, out_path, batch_id)
    keyed = new.filter("source_key is not null")
    earlier = key_log(spark, out_path).known(keyed, batch_id)
    changes = _counted(new, 1).unionByName(_counted(earlier, -1))
    before = _totals(spark, out_path, batch_id - 1) if batch_id else None
    every = changes if before is None else changes.unionByName(before)
    every.groupBy(*_STATUS).agg(F.sum("documents").alias("documents")).filter("documents <> 0").coalesce(
        1).write.mode("overwrite").parquet(f"{out_path}/totals/batch_id={batch_id}")


def _totals(spark: SparkSession, out_path: str, batch_id: int) -> DataFrame:
    return spark.read.schema("category string, error string, documents bigint").parquet(
        f"{out_path}/totals/batch_id={batch_id}")


def read_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """`(category, error, documents)`: how many documents of a stream have a category, and how many an error.

    Each document counts by its last outcome, each unreadable notification by itself.
    One small table is read, however many batches there were.
    """
    batches = [int(n.removeprefix("batch_id=")) for n in StoredPath(spark, f"{out_path}/totals").children()
               if n.startswith("batch_id=") and StoredPath(spark, f"{out_path}/totals/{n}/_SUCCESS").exists()]
    if not batches:
        return spark.createDataFrame([], "category string, error string, documents bigint")
    return _totals(spark, out_path, max(batches))


def _write_batch(found: DataFrame, out_path: str, batch_id: int) -> None:
    spark = found.sparkSession
    sinks.write_outcomes(found, f"{out_path}/outcomes/batch_id={batch_id}")
    done, _ = sinks.read_outcomes(spark, f"{out_path}/outcomes/batch_id={batch_id}")
    sinks.write_results(done, f"{out_path}/results", f"/batch_id={batch_id}")
    _write_totals(spark, out_path, batch_id)


def _start(stream: DataFrame, process, in_path: str, out_path: str, checkpoint: str | None, available_now: bool):
    assert_no_loop(in_path, out_path)
    location = checkpoint or f"{checkpoint_root(stream.sparkSession)}/arrivals/{stable_name(in_path, out_path)}"
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", location)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_stream(
    pages: DataFrame,
    in_path: str,
    out_path: str,
    checkpoint: str | None = None,
    rules: RuleSet = DEFAULT_RULES,
    available_now: bool = True,
    fmt: str = "parquet",
) -> StreamingQuery:
    """Process a page stream; each micro-batch owns its directories under `out_path`.

    A retried batch overwrites its own directories, so every document is written
    once however often a batch is tried.  A document whose pages come in several
    batches is written again from all of them, and the last outcome counts; the
    page store is read again only for such documents.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        uploads = batch.select(*IDENTITY).filter(is_pdf(F.col("source_key"))).distinct()
        known = key_log(spark, out_path).known(uploads, batch_id)
        again = uploads.join(known, list(IDENTITY), "left_semi")
        if not again.isEmpty():
            # The store holds the pages of this batch too.
            store = read_pages(spark, in_path, fmt).join(again, list(IDENTITY), "left_semi")
            batch = batch.join(again, list(IDENTITY), "left_anti").unionByName(store, allowMissingColumns=True)
        _write_batch(outcomes(documents_for(uploads, batch), rules), out_path, batch_id)

    return _start(pages, process, in_path, out_path, checkpoint, available_now)


def run_uploads_stream(
    events: DataFrame,
    pages: DataFrame,
    in_path: str,
    out_path: str,
    checkpoint: str | None = None,
    rules: RuleSet = DEFAULT_RULES,
    available_now: bool = True,
) -> StreamingQuery:
    """Process a stream of notifications (`body`) against a page table.

    Each object that has a record already is left out, however late and however
    often it is announced; objects without pages and unreadable notifications are
    rejects.  What is remembered is the written table, so nothing expires; a batch
    reads of it what the log's buckets of its own objects hold.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        announced = pdf_uploads(batch)
        done = key_log(batch.sparkSession, out_path).known(announced, batch_id).filter("has_record")
        uploads = announced.join(done, list(IDENTITY), "left_anti")
        found = with_unreadable(documents_for(uploads, pages), batch)
        _write_batch(outcomes(found, rules), out_path, batch_id)

    return _start(events, process, in_path, out_path, checkpoint, available_now)


def read_stream_results(spark: SparkSession, out_path: str) -> tuple[DataFrame, DataFrame]:
    """`(records, rejects)` over all batches written so far.

    Of a document with several outcomes the one of the last batch counts.
    """
    table = _written(spark, out_path)
    last = table.filter("source_key is not null").groupBy(*IDENTITY).agg(F.max("batch_id").alias("last_batch"))
    table = table.join(last, list(IDENTITY), "left").filter("last_batch is null or batch_id = last_batch")
    return (
        table.filter(~F.col("rejected")).select(*CSV_COLUMNS, "batch_id"),
        table.filter(F.col("rejected")).select(*REJECT_COLUMNS, "batch_id"),
    )
