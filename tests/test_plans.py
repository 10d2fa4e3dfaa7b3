"""Shapes of physical plans: what must not move, and what must be broadcast."""

import pytest
from pyspark.sql import functions as F

from docketmill.operators import billing, terms
from docketmill.operators import keywords as K
from docketmill.operators import pages as P
from docketmill.plans import pipeline
from docketmill.sources import uploads
from verification.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def source(tables):
    return tables["documents"].select(
        F.concat(F.col("doc_id"), F.lit(".pdf")).alias("source_key"), F.lit("b").alias("source_bucket"), "text")


def test_tagging_never_shuffles_and_reads_only_the_text(tables):
    text = plan(pipeline.records(P.from_text(source(tables))))
    assert "Exchange" not in text and "PythonUDF" not in text and "Python" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


@pytest.mark.parametrize("build", [
    lambda d: terms.term_counts(d), lambda d: terms.bigrams(d), lambda d: terms.cosine(d),
    lambda d: K.keyword_matches(d), lambda d: K.lines(d),
])
def test_row_level_operators_never_shuffle(tables, build):
    assert "Exchange" not in plan(build(tables["documents"].select("doc_id", "text")))


def test_rule_idf_is_broadcast(spark, tables):
    text = plan(terms.tfidf(tables["documents"], terms.rule_idf(spark), broadcast_weights=True))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_a_large_table_of_weights_is_not_broadcast(spark, tables, monkeypatch):
    monkeypatch.setattr(terms, "BROADCAST_ROWS", 100)
    with pytest.raises(ValueError):
        terms.tfidf(tables["documents"], terms.rule_idf(spark), broadcast_weights=True)


def test_frequent_tokens_are_broadcast_and_the_others_shuffled(spark, tables):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table of weights that is large
    try:
        text = plan(terms.corpus_tfidf(tables["documents"].select("doc_id", "text")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in text and "TakeOrderedAndProject" in text
    assert "hashpartitioning(_place" in text and "hashpartitioning(token" not in text


def test_a_token_in_every_document_makes_no_large_task(spark):
    rows = [(i, f"hot warm{i % 2} " + " ".join(f"w{(i * 7 + j) % 997}" for j in range(6))) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        weights = terms.idf(df)
        hot = weights.orderBy(F.desc("df"), "token").limit(100)
        placed = terms._spread(terms._weighted_rows(df, "doc_id", "text"), hot, "doc_id").repartition(16, "_place")
        sizes = [r["n"] for r in placed.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 16 and max(sizes) <= 2 * sorted(sizes)[8]
    expected = {(r["doc_id"], r["token"]): r["weight"] for r in terms.tfidf(df, terms.idf(df)).collect()}
    for hot_tokens in (0, 3, 4096):
        got = {(r["doc_id"], r["token"]): r["weight"] for r in terms.corpus_tfidf(df, hot_tokens=hot_tokens).collect()}
        assert got == expected


def test_doc_frequency_merges_before_the_shuffle(tables):
    text = plan(terms.doc_frequency(tables["documents"]))
    assert text.count("hashpartitioning") == 1 and "partial_count" in text


def test_invoice_totals_shuffle_partial_sums_of_three_columns(tables):
    text = plan(billing.invoice_totals(tables["lineitem"]))
    assert text.count("hashpartitioning") == 1 and "partial_sum" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in text


def test_no_query_uses_python_workers_or_cross_joins(spark):
    sf = "/root/testdata/sf0.001"
    light = [n for n in QUERIES if not n.startswith(("records", "processed", "audit", "rejects", "run_", "output"))]
    for name in light:
        text = plan(QUERIES[name](spark, sf))
        for bad in ("EvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, (name, bad)


def test_exploded_arrays_are_computed_once(tables):
    docs = tables["documents"].select("doc_id", "text")
    assert plan(K.keyword_matches(docs)).count("split(text") == 1
    assert plan(terms.term_counts(docs)).count("sort_array(") == 1


def test_ingest_reads_the_page_text_once(spark, tmp_path):
    """Pages are pruned by the uploads below the aggregate, and text is shuffled once."""
    rows = [("b", f"{i}.pdf", p, f"text {i} {p}") for i in range(20) for p in range(3)]
    spark.createDataFrame(rows, uploads.PAGE_SCHEMA).write.parquet(str(tmp_path / "pages"))
    wanted = spark.createDataFrame([("b", "3.pdf"), ("b", "99.pdf")], "source_bucket string, source_key string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pipeline.documents_for(wanted, uploads.read_pages(spark, str(tmp_path / "pages")))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    lines = plan.splitlines()
    assert sum("FileScan" in x and "page_text" in x for x in lines) == 1
    aggregate = min(i for i, x in enumerate(lines) if "Aggregate" in x and "collect_set" in x)
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    assert semi > aggregate  # below it
    scan = next(i for i, x in enumerate(lines) if "FileScan" in x and "page_text" in x)
    shuffles = [x for x in lines[aggregate:scan] if "Exchange hashpartitioning(source_bucket" in x]
    assert len(shuffles) <= 2  # the pages, and the keys of the uploads beside them
    assert found.count() == 2


def test_costly_work_on_few_narrow_rows_is_dealt_out(spark, tables):
    """A table in one row group and joins of narrow rows give as many tasks as the session has shuffle partitions."""
    from docketmill.operators.rows import spread
    from verification import business_text

    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buyers = tables["customer"].coalesce(1)
    made = business_text.applications(buyers)
    assert made.rdd.getNumPartitions() == wide
    assert made.count() == buyers.count()
    found = business_text.invoices(tables["lineitem"].coalesce(1), tables["orders"].coalesce(1), buyers)
    assert found.rdd.getNumPartitions() == wide
    rows = spark.createDataFrame([(None,), (1,), (1,), (2,)], "n int").coalesce(1)
    assert sorted(spread(rows, "n").collect(), key=str) == sorted(rows.collect(), key=str)
