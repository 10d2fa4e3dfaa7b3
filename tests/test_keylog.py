"""The log of a stream's keys: what it finds, and how little it reads."""

import os

import pytest
from pyspark.sql import functions as F

from docketmill.streaming import arrivals
from docketmill.streaming.keylog import IDENTITY, KeyLog, segments_before

KEYS = 40  # of a batch


def batch_rows(batch):
    """New documents, the odd ones without a record, and one that every batch has again."""
    rows = [("b", f"{batch}-{i}.pdf", batch, i % 2 == 0) for i in range(KEYS)]
    return [*rows, ("b", "again.pdf", batch, batch == 3)]


@pytest.fixture(scope="module")
def outcomes(spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("outcomes"))
    rows = [r for b in range(50) for r in batch_rows(b)]
    spark.createDataFrame(rows, "source_bucket string, source_key string, batch_id bigint, has_record boolean").withColumn(
        "batch", F.col("batch_id")).coalesce(1).write.partitionBy("batch").mode("overwrite").parquet(top)
    return lambda batch: spark.read.parquet(f"{top}/batch={batch}").select(*IDENTITY, "batch_id", "has_record")


def asked(spark, *names):
    return spark.createDataFrame([("b", n) for n in names], "source_bucket string, source_key string")


def found(df):
    return {r["source_key"]: (r["batch_id"], r["has_record"]) for r in df.collect()}


@pytest.mark.parametrize("n", [0, 1, 2, 5, 8, 50, 1023])
def test_segments_cover_every_batch_once(n):
    parts = segments_before(n)
    assert [b for start, size in parts for b in range(start, start + size)] == list(range(n))
    assert len(parts) == n.bit_count() and all(size & (size - 1) == 0 for _, size in parts)


def test_keys_of_earlier_batches_are_found(spark, outcomes, tmp_path):
    log = KeyLog(spark, str(tmp_path / "keys"), outcomes, bucket_keys=8)
    names = ["0-0.pdf", "0-1.pdf", "2-4.pdf", "6-2.pdf", "again.pdf", "nowhere.pdf", "4-5.pdf"]
    for before in (0, 1, 3, 4, 6, 5, 7):  # 5 is tried again after 6
        expected = {}
        for b in range(before):
            for _, name, _, record in batch_rows(b):
                if name in names:
                    expected[name] = (b, record or expected.get(name, (0, False))[1])
        assert found(log.known(asked(spark, *names, "0-0.pdf"), before)) == expected
        there = set(os.listdir(tmp_path / "keys")) if before else set()
        assert {f"from={s}-batches={n}" for s, n in segments_before(before)} <= there


def test_a_batch_reads_its_buckets_however_long_the_history(spark, outcomes, tmp_path):
    log = KeyLog(spark, str(tmp_path / "keys"), outcomes, bucket_keys=8)
    names = asked(spark, "3-1.pdf", "3-2.pdf", "1-9.pdf", "new.pdf")

    def read(before):
        """Files, bytes and rows that the scans of a look-up read."""
        df = log.known(names, before)
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i).metrics() for i in range(leaves.size())]
        return [sum(m.apply(name).value() for m in scans if m.contains("filesSize"))
                for name in ("numFiles", "filesSize", "numOutputRows")]

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        few, same, many = read(5), read(48), read(50)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    total = sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(tmp_path / "keys") for f in fs if f.endswith(".parquet"))
    # At most one file for each key and segment, of which there are two, two and three, of some eight keys.
    assert 0 < few[0] <= 4 * 2 and many[0] <= 4 * 3
    assert same[1] <= 1.1 * few[1] and many[1] / 3 <= 1.1 * few[1] / 2 and many[1] < total / 10
    assert max(few[2], many[2]) <= 4 * 3 * 16
    assert found(log.known(names, 50)) == {"3-1.pdf": (3, False), "3-2.pdf": (3, True), "1-9.pdf": (1, False)}


def test_the_plan_prunes_buckets(spark, outcomes, tmp_path):
    log = KeyLog(spark, str(tmp_path / "keys"), outcomes, bucket_keys=8)
    plan = log.known(asked(spark, "3-1.pdf"), 8)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan, plan
    assert "PartitionFilters: []" not in plan


def test_half_written_segments_are_written_again_and_old_ones_go(spark, outcomes, tmp_path):
    top = tmp_path / "keys"
    log = KeyLog(spark, str(top), outcomes, bucket_keys=8)
    log.prepare(3)
    half = top / "from=0-batches=2"
    for name in os.listdir(half):
        if name.startswith("done-"):
            os.remove(half / name)
    assert found(log.known(asked(spark, "1-2.pdf", "2-2.pdf"), 3)) == {"1-2.pdf": (1, True), "2-2.pdf": (2, True)}
    log.prepare(4)
    assert set(os.listdir(top)) == {"from=0-batches=2", "from=2-batches=1", "from=0-batches=4"}
    log.prepare(8)
    assert set(os.listdir(top)) == {"from=0-batches=4", "from=0-batches=8"}
    assert found(log.known(asked(spark, "1-2.pdf"), 8)) == {"1-2.pdf": (1, True)}


def test_one_hot_document_is_one_key(spark, tmp_path):
    rows = [("b", "hot.pdf", 0, False)] * 3000 + [("b", f"{i}.pdf", 0, True) for i in range(100)]
    df = spark.createDataFrame(rows, "source_bucket string, source_key string, batch_id bigint, has_record boolean")
    log = KeyLog(spark, str(tmp_path / "keys"), lambda b: df, bucket_keys=16)
    assert found(log.known(asked(spark, "hot.pdf", "7.pdf"), 1)) == {"hot.pdf": (0, False), "7.pdf": (0, True)}
    assert spark.read.parquet(str(tmp_path / "keys" / "from=0-batches=1" / "rows")).count() == 101


def test_a_batch_without_outcomes_has_no_keys(spark, tmp_path):
    log = arrivals.key_log(spark, str(tmp_path / "out"))
    assert log.known(asked(spark, "a.pdf"), 0).collect() == [] == log.known(asked(spark, "a.pdf"), 3).collect()
