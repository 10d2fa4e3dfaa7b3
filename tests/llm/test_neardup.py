import random

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketmill.llm import components, neardup as N


def plain_simhash(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(items, pairs):
    parent = {i: i for i in items}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in items}


def check_classes(rows, texts):
    prints = {i: plain_simhash(t or "") for i, t in texts.items()}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    classes = union(ids, near)
    assert {r["doc_id"]: r["component_id"] for r in rows} == classes
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aAbÉé \t\x0b \n.", max_size=60))
def test_simhash_equals_the_plain_definition(text):
    assert N.simhash(text.encode()) % 2**64 == plain_simhash(text)


def test_hash_is_that_of_spark(spark):
    text = "über den wolken muß"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] == N.simhash(text.encode())


def test_classes_against_brute_force(spark, sf_docs):
    rows = sf_docs.select("doc_id", "text")
    check_classes(N.classes(rows).collect(), {r["doc_id"]: r["text"] for r in rows.collect()})


def near_texts(n):
    """Texts of long, slightly changed copies, so that many fingerprints are a few bits apart."""
    random.seed(5)
    base = [f"w{random.randrange(10**6)}" for _ in range(600)]
    texts = {}
    for i in range(n):
        words = list(base)
        for _ in range(random.randrange(3)):
            words[random.randrange(len(words))] = f"x{random.randrange(10**6)}"
        texts[i] = " ".join(words)
    return texts


def test_crowds_are_linked_like_pairs(spark):
    texts = near_texts(120)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    fps = docs.select(N.fingerprint().alias("node")).distinct()
    ids = {r["node"] for r in fps.collect()}
    pairs = [(a, b) for a in ids for b in ids if a < b and ((a ^ b) % 2**64).bit_count() <= 4]
    assert len(pairs) > 100
    expected = union(sorted(ids), pairs)
    for crowd in (3, 10, 10_000):
        edges = [(r["a"], r["b"]) for r in N.links(fps, crowd=crowd).collect()]
        assert all(((a ^ b) % 2**64).bit_count() <= 4 for a, b in edges), crowd
        assert union(sorted(ids), edges) == expected


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(7, 7), (200, 200), (3, 0)]
    edges += [(None, 5), (300, 299)]
    found = components.roots(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r["node"]: r["root"] for r in found}
    expected = {i: 100 for i in range(100, 161)} | {i: 0 for i in range(40)} | {299: 299, 300: 299}
    assert got == expected and len(found) == len(got)
    assert components.roots(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def new_words(n):
    return [f"n{random.randrange(10**6)}" for _ in range(n)]


def near_copies(n):
    """Texts of which some differ in case and white space, some in a few words and some in most."""
    random.seed(11)
    rows = []
    for family in range(n):
        base = new_words(random.randrange(60, 400))
        copy, other = list(base), list(base)
        copy[random.randrange(len(copy))] = "changed"
        for at in random.sample(range(len(other)), len(other) // 3):
            other[at] = f"o{random.randrange(10**6)}"
        rows += [" ".join(base), "  ".join(base).upper(), " ".join(copy), " ".join(other)]
    order = random.sample(range(len(rows)), len(rows))
    return dict(zip(order, rows, strict=True))


def kept_by_brute_force(texts, limit=4):
    prints = {i: plain_simhash(t or "") for i, t in texts.items()}
    ids = sorted(prints)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= limit]
    return {i for i, root in union(ids, near).items() if i == root}


def test_one_of_each_component_stays(spark):
    texts = near_copies(60)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    kept = N.without_near_copies(docs).collect()
    assert {r["doc_id"]: r["text"] for r in kept} == {i: texts[i] for i in kept_by_brute_force(texts)}
    assert len(kept) == len({r["doc_id"] for r in kept}) < 0.8 * len(texts)


def test_given_documents_lose_their_near_copies_only(spark, sf_docs):
    kept = N.without_near_copies(sf_docs)
    assert kept.columns == sf_docs.columns
    texts = {r["doc_id"]: r["text"] for r in sf_docs.collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(kept_by_brute_force(texts))


def test_another_text_of_a_copied_id_stays(spark):
    random.seed(3)
    a, b, c = (" ".join(new_words(40)) for _ in range(3))
    rows = [(3, a), (5, a), (5, b), (5, b), (7, b.upper()), (8, c), (8, c), (9, c), (None, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [tuple(r) for r in N.without_near_copies(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, a), (5, b), (8, c), (None, a), (None, a)], key=str)


def test_a_large_family_is_one_component(spark, monkeypatch):
    monkeypatch.setattr(N.links, "__defaults__", (N.RADIUS, 8))
    texts = near_texts(60)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {r["doc_id"] for r in N.without_near_copies(docs).collect()} == kept_by_brute_force(texts)


def test_odd_rows(odd_docs, no_docs):
    classes = {}
    for r in N.classes(odd_docs).collect():
        classes.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert classes[2] == classes[3] == classes[4] == {2} and classes[8] == {1} and classes[6] == {5}
    assert classes[7] == {7}
    kept = N.without_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 5, 7, 9, 10, None, None]
    assert N.classes(no_docs).collect() == [] and N.without_near_copies(no_docs).collect() == []
