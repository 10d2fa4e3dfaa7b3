import hashlib

import pytest
from pyspark.sql import functions as F

from docketmill.llm import fingerprints as P


def ordered(rows):
    named = sorted((r for r in rows if r["doc_id"] is not None), key=lambda r: -r["doc_id"])
    return named


def bits(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def check_edits(rows, texts):
    """Rows of distinct ids against a plain loop."""
    ids = sorted(texts, reverse=True)
    by_id = {r["doc_id"]: r for r in rows}
    assert sorted(by_id) == sorted(ids)
    for at, doc_id in enumerate(ids):
        text, following = texts[doc_id] or "", texts[ids[(at + 1) % len(ids)]] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        row = by_id[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(1 - bits(row["fingerprint"], row["edited_fingerprint"]) / 128)
        following_row = by_id[ids[(at + 1) % len(ids)]]
        assert row["near_next"] == pytest.approx(1 - bits(row["fingerprint"], following_row["fingerprint"]) / 128)


def test_edits_and_likeness_against_a_loop(spark, sf_docs, monkeypatch):
    monkeypatch.setattr(P, "ROWS_OF_BLOCK", 16)  # many blocks
    rows = P.compared(sf_docs).collect()
    check_edits(rows, {r["doc_id"]: r["text"] for r in sf_docs.collect()})
    assert sum(r["near_edited"] > r["near_next"] for r in rows) > 0.95 * len(rows)


def test_sparse_and_single_ids(spark):
    rows = [(5, "a b c d e f"), (10**15, "g h i j k l m n"), (-7, None), (6, "")]
    check_edits(P.compared(spark.createDataFrame(rows, "doc_id bigint, text string")).collect(), dict(rows))
    check_edits(P.compared(spark.createDataFrame(rows[:1], "doc_id bigint, text string")).collect(), dict(rows[:1]))


def test_votes_against_a_loop(spark):
    text = "The cat saw the other cat"
    words = text.lower().split()
    found = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    hashed = spark.createDataFrame([(t,) for t in found], "t string").select(
        "t", F.xxhash64("t").alias("h0"), F.xxhash64(F.lit(1), "t").alias("h1")).collect()
    expected = ""
    for h in ("h0", "h1"):
        value = 0
        for i in range(64):
            if sum(len(r["t"]) * (1 if (r[h] >> i) & 1 else -1) for r in hashed) > 0:
                value |= 1 << i
        expected += f"{value:016x}"
    rows = P.simhashes(spark.createDataFrame([(1, text)], "id int, text string"), ["id"])
    assert rows.select(P.spelled("f0", "f1").alias("f")).first()["f"] == expected


@pytest.mark.parametrize("radius", [1, 4, 7])
def test_search_finds_all_within_the_radius(spark, radius):
    import random

    random.seed(radius)
    base = random.getrandbits(128)
    values = {base, 0, (1 << 128) - 1}
    for n in range(0, 12):
        for _ in range(6):
            v = base
            for b in random.sample(range(128), n):
                v ^= 1 << b
            values.add(v)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    rows = [(signed(v >> 64), signed(v & (2**64 - 1))) for v in values]
    fps = spark.createDataFrame(rows, "f0 bigint, f1 bigint")
    queries = fps.select(F.col("f0").alias("q0"), F.col("f1").alias("q1"))
    join = lambda a, b: ((a % 2**64) << 64) | (b % 2**64)
    got = sorted((join(r["q0"], r["q1"]), join(r["f0"], r["f1"])) for r in P.search(queries, fps, radius).collect())
    assert got == sorted((a, b) for a in values for b in values if (a ^ b).bit_count() <= radius)


def test_odd_rows(odd_docs, no_docs):
    rows = P.compared(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_text = {}
    for r in rows:
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by_text[1] == by_text[8] and by_text[5] == by_text[6]
    assert by_text[2] == by_text[3] == by_text[4] == {"0" * 32}
    assert P.compared(no_docs).collect() == []


def test_words_that_both_texts_begin_with_vote_once(spark, monkeypatch):
    texts = {
        1: "one two three four five six seven eight nine ten " * 20, 2: "ΟΔΟΣ ΣΑΣ\tΣ  ΟΔΟΣ\n\n" * 5, 3: "unbroken" * 9,
        4: " a", 5: "ab cd ", 6: "Ünïcode ßtraße İstanbul \U0001f600 naïve word and more", 7: "  \t ", 8: None, 9: "x"}
    given, votes = [], P.votes
    monkeypatch.setattr(P, "votes", lambda df, keys: given.append(df) or votes(df, keys))
    rows = P.compared(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    check_edits(rows, texts)
    of_first = given[0].where("doc_id = 1").agg(F.sum(F.size("words"))).first()[0]
    assert of_first < 1.4 * 200 + 4  # 400 if either text had all its words counted

    ids = sorted(texts, reverse=True)
    plain = []
    for at, i in enumerate(ids):
        text, following = texts[i] or "", texts[ids[(at + 1) % len(ids)]] or ""
        plain.append((i, text, text[: len(text) - len(text) // 3] + following[: len(text) // 3]))
    whole = spark.createDataFrame(plain, "id int, text string, edited string")
    for column, found in (("text", "fingerprint"), ("edited", "edited_fingerprint")):
        expected = {r["id"]: r["f"] for r in P.simhashes(whole, ["id"], column).select("id", P.spelled("f0", "f1").alias("f")).collect()}
        assert {r["doc_id"]: r[found] for r in rows} == expected
