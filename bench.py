"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from verification.queries import QUERIES  # noqa: E402

HEADLINE = [
    "classify",
    "summarize",
    "sentence_scores",
    "cosine",
    "doc_frequency",
    "lines",
    "emails",
    "invoice_totals",
    "revenue_breakdown",
    "assemble_pages",
    "events_unnest",
    "invoice_metadata",
    "keyword_matches",
    "business_scores",
    "records",
]


def prepared(spark: SparkSession, sf_dir: str, parts: int) -> str:
    """The tables in several files each, as a cluster would have them; not part of the times."""
    folder = tempfile.mkdtemp(prefix="docketmill-bench-")
    for name in ("documents", "conversations", "pages", "lineitem", "orders", "customer", "nation", "region"):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        rows.repartition(parts).write.parquet(f"{folder}/{name}.parquet")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("docketmill-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = prepared(spark, sf_dir, 2 * int(cpus))
    QUERIES["classify"](spark, tables).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 2)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 2)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
