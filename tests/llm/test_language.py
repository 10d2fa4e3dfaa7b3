import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketmill.llm import language as L

SAMPLES = {"aa": "the cat sat on the mat and the dog ran", "bb": "der hund lief und die katze saß auf der matte"}


def parse(text, source):
    """Number of longest pieces of a stretch, by looking for each of them."""
    n = at = 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in source and text[at : at + size] in source:
            size += 1
        at, n = at + size, n + 1
    return n


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abcdehmnorstuß zé", min_size=1, max_size=30), min_size=1, max_size=5))
def test_pieces_are_the_longest_ones(texts):
    models = L.build(SAMPLES)
    clean = [L.letters(t) for t in texts]
    found = L.pieces(clean, models)
    for row, text in zip(found, clean):
        for got, source in zip(row, (L.letters(s) for s in SAMPLES.values())):
            stretches = [text[i : i + L.STRETCH] for i in range(0, len(text), L.STRETCH)]
            # Letters that no sample has are one class, which ends a piece.
            known = set("".join(map(L.letters, SAMPLES.values())))
            expected = sum(parse("".join(c if c in known else "?" for c in s), source) for s in stretches)
            assert got == expected


def test_automaton_accepts_exactly_the_substrings():
    random.seed(2)
    text = [random.randrange(3) for _ in range(60)]
    arcs = L.suffix_automaton(text)
    joined = "".join(map(str, text))
    for _ in range(2000):
        word = [random.randrange(3) for _ in range(random.randrange(1, 9))]
        state = 0
        for c in word:
            state = arcs[state].get(c) if state is not None else None
        assert (state is not None) == ("".join(map(str, word)) in joined)


def test_long_texts_are_parsed_whole():
    models = L.build(SAMPLES)
    text = "the cat " * 1000
    assert L.pieces([text], models)[0, 0] == sum(
        parse(text[i : i + L.STRETCH], SAMPLES["aa"]) for i in range(0, len(text), L.STRETCH))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r for r in L.languages(docs).collect()}
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert rows.keys() == truth.keys()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    tested = [(truth[i], r["lang_pred"]) for i, r in rows.items() if r["held_out"]]
    assert np.mean([a == b for a, b in tested]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_held_out_labels_are_not_learned(spark, sf_docs):
    wrong = sf_docs.withColumn("lang", F.when(L.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert L.sample(wrong, ~L.held_out()) == L.sample(sf_docs, ~L.held_out())


def test_odd_rows(spark, odd_docs, no_docs):
    rows = L.languages(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    named = {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"]}
    assert named[2] == named[3] == named[4] == named[10] == "und" and named[1] == "en"
    unknown = L.languages(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in unknown} == {("und", 0.0)}
    assert L.languages(no_docs).collect() == []


def test_scripts_with_many_letters():
    random.seed(3)
    texts = {}
    for k, first in enumerate((0x4E00, 0x5600, 0x5E00, 0x0430, 0x03B1, 0x05D0, 0x0E01, 0xAC00)):
        alphabet = [c for c in map(chr, range(first, first + (600 if first > 0x2000 else 24))) if c.isalpha()]
        words = ["".join(random.choices(alphabet, k=3)) for _ in range(400)]
        texts[f"l{k}"] = [" ".join(random.choices(words, k=12)) for _ in range(120)]
    samples = {name: "\n".join(lines[:100]) for name, lines in texts.items()}
    tested = [(name, line) for name, lines in texts.items() for line in lines[100:]]
    dense, sparse = L.build(samples, 1 << 40), L.build(samples, 0)
    assert all(m.keys is None for m in dense.automata) and all(m.keys is not None for m in sparse.automata)
    lines = [L.letters(line) for _, line in tested]
    assert (L.pieces(lines, dense) == L.pieces(lines, sparse)).all()
    names, _ = L.predict([line for _, line in tested], L.build(samples))
    assert names == [name for name, _ in tested]
    mixed = [f"{line} {texts['l1'][0][:3]}" for name, line in tested if name == "l0"]
    assert set(L.predict(mixed, L.build(samples))[0]) == {"l0"}


def test_short_texts_fill_the_sample(spark):
    rows = [(i, f"word{i} short text", "en") for i in range(9000)] + [(10**6 + i, f"{'x' * 9000} {i}", "xx") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = L.sample(docs, F.lit(True))
    assert len(found["en"]) == L.SAMPLE_CHARS
    assert len(found["xx"]) == 3 * L.PIECE_CHARS + 2


def test_pieces_are_from_hashed_places(spark):
    docs = spark.createDataFrame([(i, "a" * 9000 + "b" * 9000, "en") for i in range(9)], "doc_id bigint, text string, lang string")
    assert "b" in L.sample(docs, F.lit(True))["en"]
