"""Searches without Unicode's classes, cues by words, and rows that are not shuffled again."""

import re

from pyspark.sql import functions as F

from docketmill.functions import text as T
from docketmill.functions.scoring import best_two, named_best, pattern_score, rule_words
from docketmill.operators import classify as C
from docketmill.operators import paged, terms
from docketmill.rules import CATEGORY_FIELDS, CUES, DEFAULT_RULES, LAYOUT_RULES, PHRASE_RULES

TEXTS = [
    "Invoice No: A-1\nInvoice Date: 2 May\nDue date 3\x1fMay, x\nBill To:\n Acme & Co \nTax (17%):\t$1,0.50\n", "",
    "TOTAL $5.00\x1c100 Region: K\nEmployer:  Ünit\nTotal amount due 7.25", "Subtotal\n$9.75 grand total due", None,
    "full name: Al\n date of birth: 1-2\nemail address employer job title annual income: $5\n", "invoiceKumber ſubtotal 1.00",
    "Employer:\n\nnext", "xinvoice_number tax_rate totals overdue", "Executive\nsummary and forecast; units\tsold, 5 %, Q3 2024",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").withColumns({
        "folded": T.fold_case(F.col("text")), "plain": T.is_ascii(F.col("text")), "words": T.words(F.col("text"))})


def test_classes_are_written_out_and_mean_the_same():
    assert T.spelled("[a-c0-2_-]x-z[^A-B]") == "[abc012_-]x-z[^AB]"
    assert T.spelled(r"[\d-x]\d", {"d": "01"}) == r"[01\-x][01]"
    assert T.spelled("[a-c-9]") == r"[abc\-9]"
    assert T.spelled("[a-c[d]]") == "[a-c[d]]"


def test_fields_follow_python(spark):
    df = frame(spark)
    patterns = [p for fields in CATEGORY_FIELDS.values() for _, _, p in fields if p]
    rows = df.select("text", *[T.first_group(F.col("text"), p).alias(f"p{k}") for k, p in enumerate(patterns)]).collect()
    for row in rows:
        for k, p in enumerate(patterns):
            found = re.search(p, row["text"], re.I) if row["text"] is not None else None
            assert row[f"p{k}"] == (found.group(1).strip() if found else None), (p, row["text"])


def test_cue_words_never_change_whether_a_pattern_occurs(spark):
    cues = rule_words(DEFAULT_RULES)
    assert {"due", "subtotal", "employer"} <= set(cues) and "invoice" not in cues
    assert T.cue_words(r"\btax\s*due\b") == T.cue_words(r"\btax\b|due") == T.cue_words(r"\b(?:tax)?due\b") == []
    assert T.cue_words(r"(?is)\bfull\s+name\b.+\bdue\b") == ["full"]
    df = frame(spark).withColumn("cues", F.filter("words", lambda w: w.isin(cues)))
    rules = [r for table in (PHRASE_RULES, LAYOUT_RULES) for rs in table.values() for r in rs]
    cols = [F.expr(pattern_score("text", "folded", "plain", [(p, 1.0)], CUES, "cues")).alias(f"p{k}")
            for k, (p, _) in enumerate(rules)]
    for row in df.select("text", *cols).collect():
        for k, (p, _) in enumerate(rules):
            assert (row[f"p{k}"] == 1.0) == bool(re.search(p, row["text"] or "", re.I)), (p, row["text"])
    assert "array_contains" in plan(C.classify(df.select("doc_id", "text")))


def test_ties_go_to_the_category_declared_first(spark):
    df = spark.createDataFrame([(0.5, 0.5, 0.1), (0.1, 0.5, 0.5), (0.0, 0.0, 0.0), (0.2, 0.1, 0.9)], "a double, b double, c double")
    scores = [F.col(n) for n in "abc"]
    top, second = best_two(scores)
    got = df.select(top.alias("t"), second.alias("s"), named_best(scores, top, list("ABC")).alias("n")).collect()
    assert [tuple(r) for r in got] == [(0.5, 0.5, "A"), (0.5, 0.5, "B"), (0.0, 0.0, "A"), (0.9, 0.2, "C")]


def test_rows_of_frequent_tokens_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, "hot " * (i % 3 + 1) + f"rare{i % 50}") for i in range(200)], "doc_id bigint, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(terms.corpus_tfidf(df, hot_tokens=2))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Union" in text and re.search(r"isnotnull\(_hot#\d+\)|BroadcastHashJoin \[token#\d+\], \[token#\d+\], Inner", text)
    expected = {(r["doc_id"], r["token"]): r["weight"] for r in terms.tfidf(df, terms.idf(df)).collect()}
    assert {(r["doc_id"], r["token"]): r["weight"] for r in terms.corpus_tfidf(df, hot_tokens=2).collect()} == expected


def test_words_of_sentences_are_dealt_out_once(spark):
    pages = spark.createDataFrame([(1, 0, "One big tree here. A big"), (1, 1, "tree again there.")], "doc_id int, page_no int, page_text string")
    text = plan(paged.sentence_scores(pages, key=["doc_id"]))
    assert not re.search(r"hashpartitioning\(doc_id#\d+, sent_no#\d+, token", text)
    assert "REPARTITION_BY_COL" in text


def test_pages_are_split_into_lines_once(spark):
    pages = spark.createDataFrame([(1, 0, "Tax: $5.00\nTax:"), (1, 1, "$7.25\nx")], "doc_id int, page_no int, page_text string")
    found = paged.keyword_matches(pages, key=["doc_id"])
    assert "page_text" not in plan(found)
    assert [(r["number_value"], r["line_no"]) for r in found.orderBy("match_no").collect()] == [(5.0, 0), (7.25, 1)]
