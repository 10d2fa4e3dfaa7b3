"""From an array per document to one row per element, and rows dealt out to tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def elements(df: DataFrame, keep: list[str], array: Column, item: str, position: str = "_pos") -> DataFrame:
    """`keep`, the position from 0 and the element, for every element of `array`.

    For an inner explode Spark infers a filter on the size of the array and pushes
    it down, so the array would be computed once for the filter and again for the
    rows.  The outer form with a later filter computes it once.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(position, item))
    return rows.filter(F.col(position).isNotNull())


def spread(df: DataFrame, *by: str) -> DataFrame:
    """The same rows, dealt out to as many tasks as the session has shuffle partitions, by a hash of the columns `by`.

    For narrow rows from which documents are made: a table in one row group, or a join whose rows
    are few bytes, gives few tasks, however much work a document is.  A given number of partitions
    is not merged again for its size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)
