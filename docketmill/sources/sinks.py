"""Record sinks and reading results back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketmill.plans.records import CSV_COLUMNS, REJECT_COLUMNS, csv_rows, json_lines
from docketmill.sources.files import StoredPath

RECORD_SCHEMA = ", ".join(
    f"{c} {'double' if c == 'confidence' else 'int' if c == 'num_pages' else 'bigint' if c == 'char_count' else 'string'}"
    for c in CSV_COLUMNS
)
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
#: Records of a CSV file.  Cells may hold line breaks, so a file is read by one task.
CSV_FILE_RECORDS = 10_000


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """All outcomes in one pass, records and rejects in partitions of their own."""
    outcomes.withColumn("rejected", F.col("error").isNotNull()).write.mode("overwrite").partitionBy(
        "rejected").parquet(path)


def read_outcomes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """`(records, rejects)` of `write_outcomes`; each reads only its partition."""
    schema = f"{RECORD_SCHEMA}, error string, rejected boolean"
    table = spark.read.schema(schema).parquet(path)
    done = table.filter(~F.col("rejected")).select(*CSV_COLUMNS)
    bad = table.filter(F.col("rejected")).select(*REJECT_COLUMNS)
    return done, bad


def write_csv(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header plus one line per record in every part file; quotes are doubled and
    missing values are empty.  No file has more than `CSV_FILE_RECORDS` records."""
    csv_rows(records).write.mode(mode).options(
        emptyValue="", maxRecordsPerFile=CSV_FILE_RECORDS, **CSV_OPTIONS).csv(path)


def write_json(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, keys in record order, nulls kept, UTF-8 unescaped."""
    json_lines(records).select("value").write.mode(mode).text(path)


SINKS = {"csv": write_csv, "json": write_json}


def _parts(folder: StoredPath) -> set[str]:
    return {n for n in folder.children() if n.startswith("part-")}


def _commits(path: str, spark: SparkSession, batch: str) -> StoredPath:
    return StoredPath(spark, f"{path}/commits{batch}")


def write_results(records: DataFrame, path: str, batch: str = "") -> None:
    """Write the records as CSV and as JSON under `path`, both or neither for those who read by `read_results`.

    New files are written beside those of an earlier run.  Then one small file, which
    names the files of both, is put in place: from there on the new pair counts.
    What it does not name, of an earlier run or of one that did not end, is removed.
    `batch` is a folder such as `/batch_id=3` within each sink.
    """
    spark = records.sparkSession
    folders = {sink: StoredPath(spark, f"{path}/{sink}{batch}") for sink in SINKS}
    before = {sink: _parts(folder) for sink, folder in folders.items()}
    for sink, write in SINKS.items():
        write(records, folders[sink].path, "append")
    named = {sink: sorted(_parts(folder) - before[sink]) for sink, folder in folders.items()}
    commits = _commits(path, spark, batch)
    earlier = commits.children()
    commits.inside(f"{max(_versions(earlier), default=0) + 1}.json").create(json.dumps(named))
    for sink, folder in folders.items():
        for name in _parts(folder) - set(named[sink]):
            folder.inside(name).delete()
    for name in earlier:
        commits.inside(name).delete()


def _versions(names: list[str]) -> list[int]:
    return [int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit()]


def read_results(spark: SparkSession, path: str, batch: str = "") -> tuple[DataFrame, DataFrame]:
    """`(records from CSV, records from JSON)` of the last run that wrote both."""
    commits = _commits(path, spark, batch)
    last = max(_versions(commits.children()), default=0)
    named = json.loads(commits.inside(f"{last}.json").text()) if last else {sink: [] for sink in SINKS}
    files = {sink: [f"{path}/{sink}{batch}/{n}" for n in names] for sink, names in named.items()}
    none = spark.createDataFrame([], RECORD_SCHEMA)
    return (read_csv(spark, files["csv"]) if files["csv"] else none,
            read_json(spark, files["json"]) if files["json"] else none)


def read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records from `write_csv`; empty cells come back as NULL."""
    return spark.read.schema(RECORD_SCHEMA).options(multiLine=True, **CSV_OPTIONS).csv(path)


def read_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records from `write_json`; nested objects come back as their JSON text."""
    return spark.read.schema(RECORD_SCHEMA).json(path)
