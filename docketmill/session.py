"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local: list[str] = []


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder the cluster names for checkpoints, else `fallback`."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    root = named or fallback
    if not root:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; a session on one machine that names none gets a temporary one."""
    alone = spark.sparkContext.master.split("[")[0] == "local"
    if not spark.conf.get(CHECKPOINT_CONF, None) and alone and not _local:
        _local.append(tempfile.mkdtemp(prefix="docketmill-"))
    return f"{checkpoint_root(spark, _local[0] if _local else None)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder, small rather than fast, and read back: computed once, and safe to lose executors."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
