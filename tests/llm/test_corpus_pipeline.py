import re

import duckdb
import pytest

import __spark_entry__ as entry_point
import corpus_pipeline as P
from docketmill.llm.oracles import ORACLES
from docketmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_every_query_is_registered():
    names = entry_point.queries()
    assert set(QUERIES) | {"pipeline"} <= set(names)
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert set(ORACLES) <= set(QUERIES)


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = duckdb.connect()
    sizes = []
    for name, stage in P.STAGES:
        before = docs
        docs = P.materialized(stage(spark, before, SF), "stage")
        sizes.append(docs.count())
        if name != P.STAGES[-1][0]:
            assert docs.columns == COLUMNS
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
        if name == "quality classifier":
            truth = con.execute(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall()
            kept = {r["doc_id"] for r in docs.collect()}
            agreed = [(i in kept) == bool(q) for i, q in truth]
            assert sum(agreed) / len(agreed) > 0.9
        if name == "near-duplicates":
            texts = [" ".join((r["text"] or "").lower().split()) for r in docs.collect()]
            assert len(texts) == len(set(texts)) and len(texts) < sizes[0]
        if name == "benchmark decontamination":
            mixed_from = docs.collect()
        if name == "source mix":
            total = sum(size(r["text"]) for r in mixed_from)
            largest = max(size(r["text"]) for r in mixed_from)
            taken = sum(size(r["text"]) for r in docs.collect())
            assert abs(taken - total) < largest * len({r["source"] for r in mixed_from})
            last = docs.collect()
    rows = docs.orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted(r["doc_id"] for r in last)
    assert [r["start"] for r in rows] == [sum(r["n_tokens"] for r in rows[:i]) for i in range(len(rows))]


def test_odd_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        docs = docs.select(*COLUMNS)
        for _, stage in P.STAGES[:-1]:
            docs = P.materialized(stage(spark, docs, SF), "stage")
            assert docs.columns == COLUMNS
        P.STAGES[-1][1](spark, docs, SF).collect()


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_give_a_row_for_each_document(spark, name):
    rows = QUERIES[name](spark, SF)
    if name == "op4_tool_call_links":
        turns = spark.read.parquet(f"{SF}/conversations.parquet")
        assert rows.count() == turns.where("role <> 'assistant'").count()
    elif name == "op12_embedding_whitening":
        assert rows.count() == 8 * spark.read.parquet(f"{SF}/embeddings.parquet").count()
    elif name == "op13_spelling_variants":
        assert rows.count() == rows.select("word").distinct().count() > 0
    else:
        ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
        assert sorted(r["doc_id"] for r in rows.collect()) == sorted(r["doc_id"] for r in ids)


@pytest.mark.parametrize("name", list(ORACLES))
def test_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    expected = con.sql(ORACLES[name]).to_arrow_table()
    got = QUERIES[name](spark, SF).toArrow().select(expected.column_names)
    rows = [sorted(map(str, t.to_pylist())) for t in (got, expected)]
    assert rows[0] and rows[0] == rows[1]
