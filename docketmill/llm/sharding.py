"""Sharding by rendezvous hashing of stable record keys.

Every shard scores every record, and the record goes to the shard with the best
score.  The score is -weight / ln(u), u being the key's and the shard's hash as a
number between 0 and 1, so a shard gets rows in proportion to its weight.  A score
depends on nothing but its own shard: with one more shard, or a greater weight, a
row either stays or moves to that shard, and with one shard less only its own rows
move.  Hashes are MD5 of text, the same in every engine and release.

`placed` gives each row its shard and its slot, a gapless number from 0 in the
order of a hash of the key.  Equal rows are counted before they are shuffled, the
counts are sorted over all tasks, and a running sum over tasks and one within each
task give the slots; so no shard or key is brought together in one task.
`write_shards` writes the whole rows, a folder for each shard.

Defined cases: a NULL key is one key, other than that of an empty text, and its
rows go to one shard; rows that repeat a key share its shard and take neighbouring
slots, in the order of their texts' checksums and sizes; a NULL text has the size
of an empty one; a shard without rows has no slots; an empty table gives no rows;
shards need weights above zero, and there must be one at least.  Other columns of
the table are neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketmill.llm.common import fresh, materialized

#: Shards of equal weight, and bytes that a row takes besides its text.
SHARDS = 24
ROW_BYTES = 8
#: The law that holds: key and shards decide.
LAW = "key"
#: Rows of one file of `write_shards` on average.
FILE_ROWS = 1 << 18


def equal_shards(n: int) -> dict[int, float]:
    return {s: 1.0 for s in range(n)}


def _key_text(key: Column) -> Column:
    """The key as text; NULL is no text of any key."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def _number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")


def place_of(key: Column) -> Column:
    """A 60-bit hash of the key, by which the rows of a shard are ordered."""
    return _number(_key_text(key), 15)


def shard_of(key: Column, shards: Mapping[int, float]) -> Column:
    """The shard whose score is greatest; the smaller number, if two are equal."""
    if not shards or any(not weight > 0 for weight in shards.values()):
        raise ValueError("there must be shards, and their weights must be above zero")
    text = _key_text(key)

    def scored(shard: Column) -> Column:
        u = (_number(F.concat(text, F.lit(":"), shard["s"].cast("string")), 13) + 0.5) / float(1 << 52)
        return F.struct((-shard["w"] / F.log(u)).alias("score"), (-shard["s"]).alias("s"))

    known = F.array(*[F.struct(F.lit(s).cast("int").alias("s"), F.lit(float(w)).alias("w")) for s, w in shards.items()])
    return (-F.array_max(F.transform(known, scored))["s"]).cast("int")


def numbered(rows: DataFrame, group: str, order: Sequence[str], slot: str = "slot") -> DataFrame:
    """`rows` with a gapless number from 0 in each group, in the order of columns that tell unequal rows apart."""
    n, part, first, before = (fresh(c, rows) for c in ("run_rows", "run_part", "run_first", "part_first"))
    runs = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias(n))
    ordered = materialized(runs.orderBy(group, *order).withColumn(part, F.spark_partition_id()), "ordered")
    until = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = ordered.groupBy(group, part).agg(F.sum(n).alias(before)).withColumn(
        before, F.coalesce(F.sum(before).over(until), F.lit(0)))
    inside = Window.partitionBy(group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed_runs = ordered.withColumn(first, F.coalesce(F.sum(n).over(inside), F.lit(0))).join(parts, [group, part])
    start = F.col(first) + F.col(before)
    return placed_runs.select(*rows.columns, F.explode(F.sequence(start, start + F.col(n) - 1)).alias(slot))


def placed(
    docs: DataFrame, shards: Mapping[int, float], grown: Mapping[int, float] | None = None,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every row.

    `grown_shard` is the row's shard among the shards `grown`, NULL without them.
    """
    raw = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(raw.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        (shard_of(F.col(key), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        place_of(F.col(key)).alias("place"))
    found = numbered(materialized(rows, "shard-rows"), "shard", ["place", key, "text_crc32", "size"])
    return found.select(key, "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")


def write_shards(
    docs: DataFrame, path: str, shards: Mapping[int, float], key: str = "doc_id", file_rows: int = FILE_ROWS,
) -> None:
    """All rows and columns as Parquet in `path`/shard=N, in files of about `file_rows` rows.

    Rows are dealt by ranges of shard, place and position in the input, so neither a
    large shard nor a frequent key makes a large task.
    """
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("the table has a column named shard; rename it before it is sharded")
    order = fresh("shard_place", docs)
    marked = docs.withColumn("shard", shard_of(F.col(key), shards)).withColumn(order, place_of(F.col(key)))
    files = -(-docs.count() // file_rows) + len(shards)
    dealt = marked.repartitionByRange(files, "shard", order, F.monotonically_increasing_id())
    dealt.sortWithinPartitions("shard", order).drop(order).write.partitionBy("shard").parquet(path)
