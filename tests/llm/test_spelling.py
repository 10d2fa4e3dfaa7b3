import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docketmill.llm import spelling as S


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(words, factor=10):
    near = {w: [o for o in words if one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= factor * words[w]:
                form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def grouped(spark, words, **kwargs):
    df = spark.createDataFrame(list(words.items()) or [], "word string, n bigint")
    return sorted(map(tuple, S.grouped(df, **kwargs).collect()), key=str)


WORDS = {
    "separate": 500, "seperate": 9, "separte": 3, "sepparate": 50, "seperat": 2, "ceparate": 51, "separated": 50,
    "natürlich": 100, "naturlich": 10, "natÜrlich": 4, "bookkeeper": 40, "bokkeeper": 4, "bookeeper": 4, "lonelyword": 7,
    "aaaaaaa": 300, "aaaaaaaa": 30, "aaaaaaaaa": 3, "aaaaaab": 300, "zzzzzzz": 20, "zzzzzzy": 200, "zzzzzzx": 200,
}


def test_groups_against_brute_force(spark):
    assert grouped(spark, WORDS) == brute_groups(WORDS)


def test_a_chain_of_forms_ends_at_its_root(spark):
    words = {"abcdefg" + "h" * k: 10 ** (9 - k) * 2 for k in range(9)}
    found = grouped(spark, words)
    assert found == brute_groups(words)
    assert {r[2] for r in found} == {"abcdefg"}
    words = {w: n for w, n in words.items() if len(w) < 9}
    assert grouped(spark, words, factor=3) == brute_groups(words, 3)


def test_a_vocabulary_beyond_one_broadcast(spark):
    random = np.random.default_rng(0)
    words = {"".join(random.choice(list("abé"), size=random.integers(7, 9))): int(n) for n in random.integers(2, 300, 400)}
    expected = brute_groups(words)
    assert sum(r[4] for r in expected) > 50
    assert grouped(spark, words) == expected
    assert grouped(spark, words, round_blocks=7) == expected


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abzéÿ", min_size=7, max_size=11), min_size=1, max_size=6, unique=True))
def test_edits_are_the_neighbourhood(words):
    alphabet = np.array(sorted(map(ord, "abzéÿ")), dtype=np.uint64)
    got = set()
    for rows, hashes, lengths in S.edits(S._Spelled(pa.array(words)), alphabet):
        got |= set(zip(rows.tolist(), hashes.tolist(), lengths.tolist(), strict=True))
    expected = set()
    for k, w in enumerate(words):
        near = {w[:i] + w[i + 1 :] for i in range(len(w))}
        near |= {w[:i] + chr(c) + w[i + 1 :] for i in range(len(w)) for c in alphabet.tolist() if c < ord(w[i])}
        expected |= {(k, int(h), len(e)) for e, h in zip(near, S.keys(pa.array(list(near))), strict=True)}
    assert got == expected


def test_the_filter_has_no_false_negatives_and_few_false_positives():
    random = np.random.default_rng(1)
    hashes = random.integers(0, 1 << 63, 20000, dtype=np.uint64)
    lengths = random.integers(7, 80, len(hashes))
    layout = S.Layout(dict(zip(*map(np.ndarray.tolist, np.unique(np.minimum(lengths, S.LONG), return_counts=True)), strict=True)))
    block, bits = layout.places(hashes[:10000], lengths[:10000])
    table = S.filled(block, bits, layout.blocks)
    assert len(S.contains(table, block, bits)) == 10000
    block, bits = layout.places(hashes[10000:], lengths[10000:])
    assert len(S.contains(table, block, bits)) < 100
    assert (layout.places(hashes[:5], np.array([0, 1, 5, 6, 3]))[0] == -1).all()


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = sorted(map(tuple, S.variants(odd_docs).collect()), key=str)
    assert got == brute_groups(brute_words(odd_rows))
    empty = S.variants(no_docs)
    assert empty.columns == ["word", "form", "root", "n", "n_near", "form_n"] and empty.collect() == []


def test_texts_against_brute_force(spark):
    rows = [(i, f"The Quality of MEASUREMENT{'S' * (i % 3)} in naïveté, x{i} measurément ÀÉmeasure×÷ment " * 3) for i in range(150)]
    rows += [(None, "measurement quality" * 40), (3, "measurement\tmeasurement")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, S.vocabulary(docs).collect())) == sorted(brute_words(rows).items())
    assert sorted(map(tuple, S.variants(docs).collect()), key=str) == brute_groups(brute_words(rows))


def test_long_texts_are_cut_at_the_end_of_a_run(monkeypatch):
    text = "alphabet soupspoon x é " * 40 + "y" * 100 + " endwords"
    whole = S.document_words(5, text)
    for piece in (1, 7, 64, 150):
        monkeypatch.setattr(S, "PIECE", piece)
        assert S.document_words(5, text) == whole


def test_parts_of_a_task_are_bounded(spark, monkeypatch):
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "t": ["abcdefgh qwertzui"] * 3})
    monkeypatch.setattr(S, "HELD_WORDS", 2)
    parts = list(S._count(iter([batch])))
    assert len(parts) == 3 and all(p.num_rows == 2 for p in parts)


def test_plan_counts_before_the_shuffle(spark, sf_docs):
    plan = S.vocabulary(sf_docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("MapInArrow") and "partial_sum" in plan


@pytest.mark.parametrize("rounds", [1, 64])
def test_only_positives_are_shuffled(spark, rounds):
    words = spark.createDataFrame(list(WORDS.items()), "word string, n bigint").select("word", "n")
    keyed = words.mapInArrow(S._with_keys, "word string, n bigint, key bigint")
    alphabet = np.array(sorted({ord(c) for w in WORDS for c in w}), dtype=np.uint64)
    found = S.positives(keyed, S.Layout(dict(Counter(map(len, WORDS)))), alphabet, rounds).distinct().collect()
    own = dict(zip(S.keys(pa.array(list(WORDS))).view(np.int64).tolist(), WORDS, strict=True))
    pairs = {frozenset((own[r["a"]], own[r["b"]])) for r in found if r["b"] in own}
    assert pairs == {frozenset((a, b)) for a in WORDS for b in WORDS if one_edit(a, b)}
