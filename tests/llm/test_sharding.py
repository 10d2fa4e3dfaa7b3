import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from docketmill.llm import sharding as S

EIGHT = {s: 1.0 for s in range(8)}


def number(text, digits):
    return int(hashlib.md5(text.encode()).hexdigest()[:digits], 16)


def expected_shard(key, shards):
    text = "" if key is None else f"={key}"
    scores = {s: -w / math.log((number(f"{text}:{s}", 13) + 0.5) / 2**52) for s, w in shards.items()}
    return max(scores, key=lambda s: (scores[s], -s))


def shards_of(spark, keys, shards):
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    return {r["k"]: r["s"] for r in df.select("k", S.shard_of(df["k"], shards).alias("s")).collect()}


@pytest.mark.parametrize("shards", [EIGHT, {0: 1.0, 5: 2.5, 3: 0.25}, {7: 1.0}])
def test_shards_are_those_of_brute_force(spark, shards):
    got = shards_of(spark, [*range(300), None, -5, 1 << 60], shards)
    assert got == {k: expected_shard(k, shards) for k in got}


def test_shards_follow_their_weights(spark):
    shards = {0: 1.0, 1: 2.0, 2: 5.0}
    counts = Counter(shards_of(spark, range(8000), shards).values())
    for s, w in shards.items():
        assert abs(counts[s] / 8000 - w / 8) < 0.02


def test_few_rows_move(spark):
    before = shards_of(spark, range(3000), EIGHT)
    grown = shards_of(spark, range(3000), {**EIGHT, 8: 1.0})
    moved = {k for k in before if before[k] != grown[k]}
    assert {grown[k] for k in moved} == {8} and abs(len(moved) / 3000 - 1 / 9) < 0.03
    heavier = shards_of(spark, range(3000), {**EIGHT, 3: 2.0})
    assert {heavier[k] for k in before if before[k] != heavier[k]} == {3}
    fewer = shards_of(spark, range(3000), {s: w for s, w in EIGHT.items() if s != 2})
    assert {before[k] for k in before if before[k] != fewer[k]} == {2}


def expected(rows, shards, grown):
    by_shard = defaultdict(list)
    for key, text in rows:
        raw = (text or "").encode()
        place = number("" if key is None else f"={key}", 15)
        by_shard[expected_shard(key, shards)].append(
            (place, key is not None, key or 0, zlib.crc32(raw), len(raw) + 8))
    out = []
    for shard, members in by_shard.items():
        for slot, (_, some, key, crc, size) in enumerate(sorted(members)):
            key = key if some else None
            out.append((key, size, crc, "key", shard, slot, expected_shard(key, grown) if grown else None))
    return sorted(out, key=str)


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    grown = {**EIGHT, 8: 1.0}
    got = S.placed(odd_docs, EIGHT, grown)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(odd_rows, EIGHT, grown)
    assert all(r["grown_shard"] is None for r in S.placed(odd_docs, EIGHT).collect())
    assert S.placed(no_docs, EIGHT, grown).collect() == []
    for bad in ({}, {0: 0.0}, {0: -1.0}, {0: float("nan")}):
        with pytest.raises(ValueError):
            S.placed(odd_docs, bad)


def test_hot_keys_and_equal_rows_get_gapless_slots(spark):
    rows = [(None, None)] * 400 + [(7, f"text {i % 50}") for i in range(400)] + [(i, "same") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted(map(tuple, S.placed(docs, EIGHT).collect()), key=str)
    assert got == expected(rows, EIGHT, None)


def test_written_shards_hold_whole_rows(spark, odd_docs, tmp_path):
    S.write_shards(odd_docs, str(tmp_path / "shards"), EIGHT, file_rows=3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(str, back.select(odd_docs.columns).collect())) == sorted(map(str, odd_docs.collect()))
    assert all(r["shard"] == expected_shard(r["doc_id"], EIGHT) for r in back.collect())
    with pytest.raises(ValueError):
        S.write_shards(back, str(tmp_path / "again"), EIGHT)


def test_no_exchange_of_texts(spark, sf_docs):
    plan = S.placed(sf_docs, EIGHT)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "text#" not in plan
