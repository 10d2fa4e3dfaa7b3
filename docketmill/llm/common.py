"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word contracts: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"

_fallback: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    A session that names none (local tests) gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _fallback:
        _fallback.append(tempfile.mkdtemp(prefix="docketmill-"))
    return _fallback[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, mode: str = "error") -> DataFrame:
    """`df` written as Parquet to `path` and read back: cut from its lineage, safe to lose executors."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized(df: DataFrame, name: str) -> DataFrame:
    """`df` written to a folder of its own in the shared folder and read back."""
    return written(df, new_path(df.sparkSession, name))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the id as text; a NULL id counts as 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0))


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fresh(name: str, df: DataFrame) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
