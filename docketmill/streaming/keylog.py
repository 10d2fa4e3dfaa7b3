"""What a stream has written before, found without reading all of it.

The outcomes of the batches are the truth; this log is an index of their keys that
can be built again from them.  It is kept in segments.  A segment covers a run of
batches whose number is a power of two, and the segments that cover the batches
before a given one have the sizes of that number's binary digits: few segments,
and a key is written again only each time the number of batches behind it doubles.

The rows of a segment lie in hash buckets of their document, as many as keep about
`BUCKET_KEYS` keys in each.  To look up the documents of a batch, only the buckets
they hash to are read of each segment, so what is read follows the batch and not
the history.  A segment is complete when its marker file is there: one that a lost
driver left half written is written again, and a retried batch finds the segments
it found before.  A segment is removed once no batch that can be retried needs it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketmill.operators.pages import IDENTITY
from docketmill.sources.files import StoredPath

#: Keys of one bucket of a segment on average.
BUCKET_KEYS = 1 << 14
#: Bits of the hash of a document, so 2**30 buckets at most.
_HASH_BITS = 30
#: The marker of a complete segment; the number of its buckets follows.
_DONE = "done-"

SCHEMA = "source_bucket string, source_key string, batch_id bigint, has_record boolean"


def segments_before(batch_id: int) -> list[tuple[int, int]]:
    """`(first batch, number of batches)` of the segments that cover all batches before `batch_id`."""
    found, start = [], 0
    for bit in reversed(range(batch_id.bit_length())):
        if batch_id >> bit & 1:
            found.append((start, 1 << bit))
            start += 1 << bit
    return found


def _hash() -> Column:
    """A hash of a document that is the same in every run, not negative."""
    return F.xxhash64(*IDENTITY).bitwiseAND(F.lit((1 << _HASH_BITS) - 1)).cast("int")


class KeyLog:
    """The keys of a stream's outcomes.

    `outcomes(batch_id)` gives the `(source_bucket, source_key, batch_id, has_record)`
    that a batch has written, and the columns that `more` declares, such as
    `category string`; of these the last batch's values are kept.
    """

    def __init__(
        self, spark: SparkSession, path: str, outcomes: Callable[[int], DataFrame], bucket_keys: int = BUCKET_KEYS,
        more: str = "",
    ):
        self.spark, self.path, self.outcomes, self.bucket_keys = spark, path.rstrip("/"), outcomes, bucket_keys
        self.schema = ", ".join(filter(None, [SCHEMA, more]))
        self.more = [c.split()[0] for c in more.split(",") if c.strip()]

    def known(self, keys: DataFrame, before: int) -> DataFrame:
        """`(source_bucket, source_key, batch_id, has_record, *more)` of those of the distinct `keys` that
        batches before `before` have written: the last batch, and whether any gave a record.

        The numbers of the buckets that the keys hash to are all that the driver learns.
        """
        self.prepare(before)
        buckets = {segment: self._buckets(segment) for segment in segments_before(before)}
        hashed = keys.select(*IDENTITY).distinct().withColumn("_bucket", _hash() % max(buckets.values(), default=1))
        touched = {r[0] for r in hashed.select("_bucket").distinct().collect()}
        parts = []
        for segment, n in buckets.items():
            # Numbers of buckets are powers of two, so a coarser bucket follows from a finer one.
            rows = self._read(segment).where(F.col("bucket").isin(sorted({t % n for t in touched})))
            parts.append(rows.join(hashed, list(IDENTITY), "left_semi").drop("bucket"))
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        found = parts[0]
        for part in parts[1:]:
            found = found.unionByName(part)
        return self._merged(found)

    def prepare(self, before: int) -> None:
        """Write the segments that cover the batches before `before` and are not there yet; drop what is left over."""
        wanted = segments_before(before)
        for segment in wanted:
            if not self._buckets(segment):
                self._write(segment)
        # The batch before may still be retried.
        needed = {_name(s) for s in [*wanted, *segments_before(max(before - 1, 0))]}
        for name in StoredPath(self.spark, self.path).children():
            if name not in needed:
                StoredPath(self.spark, f"{self.path}/{name}").delete()

    def _write(self, segment: tuple[int, int]) -> None:
        rows = self._merged(self._rows(*segment))
        keys, n = rows.count(), 1
        while n * self.bucket_keys < keys and n < 1 << _HASH_BITS:
            n *= 2
        bucketed = rows.withColumn("bucket", _hash() % n)
        # One task writes all of a bucket.
        dealt = bucketed.repartition(F.col("bucket")).sortWithinPartitions("bucket", *IDENTITY)
        path = self._path(segment)
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/rows")
        StoredPath(self.spark, f"{path}/{_DONE}{n}").create()

    def _rows(self, first: int, size: int) -> DataFrame:
        """Rows of the batches from complete segments, and of the rest from the outcomes themselves."""
        if self._buckets((first, size)):
            return self._read((first, size)).drop("bucket")
        if size == 1:
            return self.outcomes(first)
        return self._rows(first, size // 2).unionByName(self._rows(first + size // 2, size // 2))

    def _read(self, segment: tuple[int, int]) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self._path(segment)}/rows")

    def _buckets(self, segment: tuple[int, int]) -> int:
        """Number of buckets of a complete segment, 0 of one that is not."""
        names = [n.removeprefix(_DONE) for n in StoredPath(self.spark, self._path(segment)).children() if n.startswith(_DONE)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row a document: its last batch and what that says, and whether any gave a record."""
        last = F.max_by(F.struct("batch_id", *self.more), "batch_id").alias("_last")
        return rows.groupBy(*IDENTITY).agg(last, F.bool_or("has_record").alias("has_record")).select(
            *IDENTITY, "_last.batch_id", "has_record", *[f"_last.{c}" for c in self.more])

    def _path(self, segment: tuple[int, int]) -> str:
        return f"{self.path}/{_name(segment)}"


def _name(segment: tuple[int, int]) -> str:
    return f"from={segment[0]}-batches={segment[1]}"
