"""Connected components of an edge table by alternating large and small stars.

Every round hangs the larger neighbours of a node on its smallest neighbour, then
the smaller ones, until nothing changes; the number of rounds grows with the
logarithm of the longest chain.  Minima are summed before they are shuffled and
joined back, so a hub with very many neighbours can be split by the adaptive
join.  Every round is written to the shared folder, in turn over the last but one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketmill.llm.common import new_path, written


def _hang(edges: DataFrame) -> DataFrame:
    """Rows (u, v, m): m is the smallest neighbour of u."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    hung = _hang(both)
    return hung.where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    hung = _hang(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    return (
        hung.select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e"))
        .select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u <> v"))


def _mark(edges: DataFrame) -> tuple:
    hashes = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(hashes.bitwiseAND(F.lit((1 << 31) - 1))), F.bit_xor(hashes)).first())


def roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge to another; root is the smallest reachable node.

    `a` and `b` are of one orderable type.  Loops and repeated edges are
    harmless, edges with a NULL end are no links, and no edges give no rows.
    """
    paths = [new_path(edges.sparkSession, "links") for _ in range(2)]
    current = written(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u <> v").distinct(), paths[0])
    mark = _mark(current)
    while mark[0]:
        paths.reverse()
        current = written(_small_star(_large_star(current).distinct()).distinct(), paths[0], "overwrite")
        before, mark = mark, _mark(current)
        if mark == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
