import hashlib
import re

import duckdb
import pytest

from docketmill.llm import decontaminate as D
from docketmill.llm.oracles import ORACLES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    found = []
    for doc_id, text in docs:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            v = words(item)
            n = min(10, len(v))
            for window in {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else ():
                for at in range(len(w) - n + 1):
                    if tuple(w[at : at + n]) == window:
                        hit.update(range(at, at + n))
                        names.add("null" if name is None else str(name))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        found.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(found, key=str)


DOCS = [
    (1, "a b c d e f g h i j k l m"), (2, "x A, B; C. d e f g h i j y z"), (3, None), (4, ""), (5, "..."),
    (6, "short one here"), (7, "k l short ONE"), (8, "é ß Ü a b c d e f g h i j"), (8, "é ß Ü a b c d e f g h i j"),
    (None, "short one"), (9, "a a a a a a a a a a a a a"), (10, "filler " * 3000 + "a b c d e f g h i j " + "end " * 700),
]
ITEMS = [
    (1, "a b c d e f g h i j"), (2, "b c d e f g h i j k l"), (10, "Short one"), (3, "here"), (4, None), (5, "--"),
    (None, "é ß Ü"), (7, "a a a a a a a a a a"), (1, "a b c d e f g h i j"), (12, "q r s t u v w x y z short"),
]


def tables(spark):
    return (spark.createDataFrame(DOCS, "doc_id bigint, text string"),
            spark.createDataFrame(ITEMS, "item_id bigint, text string"))


@pytest.mark.parametrize("limit", [D.BLOCK_OF_ITEMS, 40])
def test_against_brute_force(spark, limit):
    docs, items = tables(spark)
    got = D.report(D.find_benchmark(docs, items, limit=limit)).collect()
    assert sorted(map(tuple, got), key=str) == brute(DOCS, ITEMS)


def test_lanes_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "LANE", 3)
    docs, items = tables(spark)
    sets = D.pattern_sets([(str(i), t) for i, t in ITEMS if t])
    import pyarrow as pa

    found = list(D.search(pa.array([t for _, t in DOCS]), sets))
    assert [int(hit.sum()) for _, hit, _ in found] == [r[2] for _, r in sorted(
        (i, brute([d], ITEMS)[0]) for i, d in enumerate(DOCS))]


def test_twin(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = D.report(D.find_benchmark(docs, items))
    expected = con.execute(ORACLES["op6_decontaminate"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected) and any(r[5] for r in expected)


def test_odd_rows(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one")], "item_id bigint, text string")
    none = items.where("false")
    kept = D.without_benchmark(odd_docs, items)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 8, 8, None, None, 9, 10]))
    assert D.without_benchmark(odd_docs, none).count() == odd_docs.count()
    assert D.without_benchmark(no_docs, items).collect() == []
