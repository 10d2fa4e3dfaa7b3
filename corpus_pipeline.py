"""The training-data pipeline: from raw documents to token files.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as
Parquet and read again as the documents of the next.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketmill.llm import decontaminate, mixture, neardup, quality, tokenids
from docketmill.llm.common import materialized, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, accepts."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHashes of word shingles that are linked by a few differing bits."""
    return neardup.without_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten words of a benchmark item occur."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, each as many times as it is taken."""
    return mixture.repeated(docs, F.array(F.col("source").cast("string")))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    return tokenids.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("near-duplicates", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("source mix", mix_sources),
    ("token files", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialized(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: Trained scores, hashes and token ids are no SQL; the stages are tested against brute force.
ORACLE_SQL = None

PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {}
