import json
import math
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docketmill.functions import jsontext
from docketmill.functions import text as T
from docketmill.operators import keywords as K
from docketmill.operators import metadata as M
from docketmill.operators import pages as P
from docketmill.operators import terms
from docketmill.operators.classify import classify
from docketmill.operators.summarize import summarize
from docketmill.rules import FIELD_ALIASES, PROTOTYPES, STOPWORDS, RuleSet
from docketmill.plans import pipeline
from docketmill.sources import uploads

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")


def fields_of(spark, text):
    rows = K.keyword_fields(docs(spark, [text])).collect()
    return {r["field"]: json.loads(r["value"]) for r in rows}


@pytest.mark.parametrize("text, expected", [
    ("Tax:\n$5.00", {"tax": 5.0}),
    ("Tax: \n$5.00", {}),
    ("Tax: $10.00\nGST: $5.00", {"tax": [10.0, 5.0]}),
    ("Tax: $5.00\nTax: $5.00", {"tax": 5.0}),
    ("Tax: -$5.00", {"tax": 5.0}),
    ("Tax: ,", {}),
    ("Taxes: $5.00", {}),
    ("  SALES   Tax (5%) - $1,023.75 incl.", {"tax": 1023.75}),
    ("Email Address: write to a.b@c.org now", {"email": "a.b@c.org"}),
    ("Phone: call +1 (555) 123-4567 today", {"phone": "+1 (555) 123-4567"}),
    ("Invoice #: A-1", {"invoice_number": "A-1"}),
    ("Name\nDOB:\n1990", {"applicant_name": "DOB", "date_of_birth": "1990"}),
    ("Subtotal: 99999999999999999", {"subtotal": 1e17}),
    ("Region: say \"hi\" \\ ü", {"region": 'say "hi" \\ ü'}),
    ("Total Due (net", {}),
])
def test_label_values(spark, text, expected):
    assert fields_of(spark, text) == expected


LABELS = [a for aliases in FIELD_ALIASES.values() for a in aliases]
PIECES = ["Tax", "GST", "sales  tax", "Name", "name", "Email", "ſubtotal", "subtotal", "inv #", "(x)", "(", ")", ":", "-",
          " ", "  ", "\t", "$5.00", "1,000", "value", "a@b.co", "\n", "\r\n", "\x0b", "Taxes", "\xa0"]


@QUICK
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=10, max_size=40))
def test_label_lookup_equals_one_search_per_label(spark, texts):
    def clean(v):
        return re.sub(r"\s+", " ", v).strip(" :-\t") or None

    def raw_values(text):
        found = []
        rows = text.splitlines()
        for alias in LABELS:
            label = r"\s+".join(re.escape(w) for w in alias.split(" "))
            head = rf"(?i)^\s*{label}(?![A-Za-z0-9])(?:\s*\([^)]*\))?\s*"
            for n, row in enumerate(rows):
                m = re.match(head + r"[:\-]\s*(.+)$", row)
                if m:
                    value = clean(m.group(1))
                elif re.match(head + r"[:\-]?\s*$", row) and n + 1 < len(rows):
                    value = clean(rows[n + 1])
                else:
                    continue
                if value:
                    found.append((alias, n, value))
        return sorted(found)

    from docketmill.functions import labels as L
    from docketmill.rules import DEFAULT_RULES

    out = docs(spark, texts).select("doc_id", L.label_lines(F.col("text"), L.alias_map(DEFAULT_RULES), LABELS).alias("x"))
    got = {r["doc_id"]: sorted((x["label"], x["line_no"], x["raw_value"]) for x in r["x"]) for r in out.collect()}
    assert [got[i] for i in range(len(texts))] == [raw_values(t) for t in texts]


def test_spaces_are_collapsed_once_a_text_not_once_a_line(spark):
    from docketmill.functions import labels as L
    from docketmill.rules import DEFAULT_RULES

    texts = ["Tax:  $5\t00\n TAX (17%) -\xa0a  b\nBill\u3000To:\n  Some\t Name - \nTax", "Phone \u212a: 1", "\u017fubtotal: 7"]
    found = docs(spark, texts).select("doc_id", L.label_lines(F.col("text"), L.alias_map(DEFAULT_RULES), LABELS).alias("x"))
    got = {r["doc_id"]: [(x["line_no"], x["label"], x["raw_value"]) for x in r["x"]] for r in found.collect()}
    assert got == {0: [(0, "tax", "$5 00"), (1, "tax", "a b"), (2, "bill to", "Some Name")], 1: [], 2: [(0, "subtotal", "7")]}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # One for the spaces, one for what is before a value.
    assert plan.count("regexp_replace(") == 2


SIGNED = ["tax", "tax - net", "tax (17%)", "e-mail", "e-mail (work)", "ship-to: name", "(ref)", "no.:", "-x", "name", "a:b-c(d"]
SIGNED_PIECES = ["Tax", " - net", "(17%)", " (17%)", "E-Mail", "(work)", "Ship-To:", " Name", "(ref)", "No.", ":", "-", "-X", "a:b-c(d",
                 " ", "  ", "\t", "\xa0", "$5.00", "v", "1", "(", ")", "\n", "\r\n", "TAX", "e-mail"]


@QUICK
@given(st.lists(st.lists(st.sampled_from(SIGNED_PIECES), max_size=10).map("".join), min_size=20, max_size=60))
def test_signed_labels_equal_one_search_per_label(spark, texts):
    from docketmill.functions import labels as L

    rules = RuleSet(field_aliases={f"f{i}": [a] for i, a in enumerate(SIGNED)})

    def clean(v):
        return re.sub(r"\s+", " ", v).strip(" :-\t") or None

    def raw_values(text):
        found, rows = [], text.splitlines()
        for alias in SIGNED:
            label = r"\s+".join(re.escape(w) for w in alias.split(" "))
            head = rf"(?i)^\s*{label}(?![A-Za-z0-9])(?:\s*\([^)]*\))?\s*"
            for n, row in enumerate(rows):
                m = re.match(head + r"[:\-]\s*(.+)$", row)
                if m:
                    value = clean(m.group(1))
                elif re.match(head + r"[:\-]?\s*$", row) and n + 1 < len(rows):
                    value = clean(rows[n + 1])
                else:
                    continue
                if value:
                    found.append((alias, n, value))
        return sorted(found)

    hits = docs(spark, texts).select("doc_id", L.line_hits(T.lines(F.col("text")), rules).alias("x")).collect()
    got = {r["doc_id"]: sorted((x["matched_label"], x["line_no"], x["raw_value"]) for x in r["x"]) for r in hits}
    assert [got[i] for i in range(len(texts))] == [raw_values(t) for t in texts]


@pytest.mark.parametrize("aliases", [["a", "a"], ["Tax"], ["two  spaces"], [" lead"], ["trail "], [""]])
def test_labels_that_are_refused(aliases):
    with pytest.raises(ValueError):
        RuleSet(field_aliases={"f": aliases}).alias_rows


def brute_summary(text, n):
    parts = re.split(r"(?<=[.!?])\s+(?=[A-Z\"'])", re.sub(r"\s+", " ", text.strip()))
    sents = [p for p in parts if len(p.split()) >= 4]
    if len(sents) <= n:
        return " ".join(sents)
    toks = [[w for w in (x.lower() for x in re.findall(r"[A-Za-z][A-Za-z\-']+", p)) if w not in STOPWORDS and len(w) > 2]
            for p in sents]
    freq = Counter(w for t in toks for w in t)
    if not freq:
        return " ".join(sents[:n])
    scored = [(-sum(freq[w] for w in t) / len(t), i) for i, t in enumerate(toks) if t]
    return " ".join(sents[i] for i in sorted(i for _, i in sorted(scored)[:n]))


SENTENCE = st.lists(st.sampled_from("alpha beta gamma delta of the a it's No 12 x".split()), min_size=1, max_size=7).map(
    lambda w: " ".join(w).capitalize() + ".")


@QUICK
@given(st.lists(st.lists(SENTENCE, max_size=9).map(" ".join), min_size=5, max_size=25), st.integers(1, 4))
def test_summary_equals_brute_force(spark, texts, n):
    out = summarize(docs(spark, texts), n).collect()
    got = {r["doc_id"]: r["summary"] for r in out}
    assert [got[i] for i in range(len(texts))] == [brute_summary(t, n) for t in texts]


@pytest.mark.parametrize("text, expected", [
    ("", ""), ("Yes. No. Fine.", ""), ("   \n ", ""),
    ("It is of the. It was of an. It has of it. He had of us.", "It is of the. It was of an. It has of it."),
])
def test_summary_edges(spark, text, expected):
    assert summarize(docs(spark, [text])).first()["summary"] == expected


def brute_cosines(text):
    def bag(t):
        w = re.findall("[a-z][a-z0-9]+", t.lower())
        return Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])])

    protos = {c: bag(t) for c, t in PROTOTYPES.items()}
    df = Counter(t for b in protos.values() for t in b)
    idf = {t: math.log(4 / (1 + n)) + 1 for t, n in df.items()}
    vec = {t: n * idf.get(t, 1.0) for t, n in bag(text).items()}
    out = {}
    for c, b in protos.items():
        pv = {t: n * idf[t] for t, n in b.items()}
        norms = math.sqrt(sum(x * x for x in vec.values())) * math.sqrt(sum(x * x for x in pv.values()))
        out[c] = sum(vec[t] * pv[t] for t in vec.keys() & pv.keys()) / norms if norms else 0.0
    return out


def test_cosine_equals_brute_force(spark, tables):
    extra = [(-1, "12 34"), (-2, " ".join(PROTOTYPES["Invoice"].split() * 3)), (-3, "to to to tax tax zz zz zz of")]
    sample = tables["documents"].select("doc_id", "text").union(
        spark.createDataFrame(extra, "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in sample.collect()}
    got = terms.cosine(sample).collect()
    assert len(got) == 3 * len(texts)
    for r in got:
        assert r["similarity"] == pytest.approx(brute_cosines(texts[r["doc_id"]])[r["category"]], abs=1e-12)


def test_no_evidence_is_unknown_with_the_first_category(spark):
    r = classify(docs(spark, ["12 34 56"])).first()
    assert (r["category"], r["best_match"], r["confidence"]) == ("Unknown", "Invoice", 0.0)


def test_only_similarity_passes_the_threshold_exactly(spark):
    r = classify(docs(spark, ["income title"])).first()
    assert r["scores"]["customer_application"] == 0.35 and r["category"] == "Customer Application"


@pytest.mark.parametrize("category, text, name, expected", [
    ("Invoice", "Invoice notes", "invoice_number", "tes"),
    ("Invoice", "Tax: $5.00", "tax", None),
    ("Invoice", "Tax (5%): $1,005.00", "tax", 1005.0),
    ("Invoice", "Invoice Date: 3 May 2024, late\nx", "invoice_date", "3 May 2024"),
    ("Invoice", "Bill To: \n(x\n", "bill_to", ""),
    ("Sales Report", "regional growth", "region", "al growth"),
    ("Sales Report", "got $5 and $1,000.50 and $7.5", "total_revenue", 1000.5),
    ("Sales Report", "TOTAL $12.00 100.0%, $99", "total_revenue", 12.0),
    ("Sales Report", "none", "total_revenue", None),
    ("Customer Application", "Phone Number: +1 22\n33 x", "phone", "+1 22\n33"),
    ("Customer Application", "SSN of\nall: 12-3", "national_id", "12-3"),
    ("Customer Application", "Annual Income: $45,000 ", "annual_income", "$45,000"),
])
def test_metadata_traps(spark, category, text, name, expected):
    assert M.category_metadata(docs(spark, [text]), category).first()[name] == expected


def test_unknown_category_gets_a_warning(spark):
    df = docs(spark, ["x"]).withColumn("category", F.lit("Unknown"))
    assert M.metadata(df).first()["metadata"] == "{\"warning\": \"No extractor registered for category 'Unknown'.\"}"


def test_json_texts_follow_python(spark):
    numbers = [0.0, 875.0, 148.75, 0.0632, 0.0001, 12345678.9, 1e15, 123456789012345.67, 1e16, 1.5e16, 1e19, 1e22]
    strings = ["a", 'q"\\', "line\nbreak\ttab", "ü€ 漢", "[x]", "", "null"]
    df = spark.createDataFrame([(float(n),) for n in numbers], "v double").select(jsontext.number(F.col("v")).alias("j"))
    assert [r["j"] for r in df.collect()] == [json.dumps(n) for n in numbers]
    df = spark.createDataFrame([(s,) for s in strings], "v string").select(jsontext.string(F.col("v")).alias("j"))
    assert [r["j"] for r in df.collect()] == [json.dumps(s, ensure_ascii=False) for s in strings]


def test_own_categories_and_aliases_are_data(spark):
    rules = RuleSet(
        prototypes={"Memo": "memo from to subject", "Menu": "soup salad fish dessert"},
        phrase_rules={"Memo": [(r"\bmemo\b", 2.0)], "Menu": [(r"\bsoup\b", 2.0)]},
        layout_rules={}, category_fields={"Memo": [("subject", "text", r"Subject:\s*([^\n]+)")]},
        field_aliases={"sender": ["from", "sent by"]},
    )
    text = "MEMO\nFrom: Ann\nSubject: Soup"
    r = M.metadata(classify(docs(spark, [text]), rules), rules).first()
    assert r["category"] == "Memo" and json.loads(r["metadata"]) == {"subject": "Soup"}
    assert [x["field"] for x in K.keyword_fields(docs(spark, [text]), rules).collect()] == ["sender"]


def test_corpus_tfidf_equals_brute_force(spark):
    texts = ["red blue red", "blue green", ""]
    df = docs(spark, texts)
    out = {(r["doc_id"], r["token"]): r["weight"] for r in terms.tfidf(df, terms.idf(df)).collect()}
    assert out[(0, "red")] == pytest.approx(2 / 5 * (math.log(4 / 2) + 1))
    assert out[(1, "blue")] == pytest.approx(1 / 3 * (math.log(4 / 3) + 1))
    assert len(out) == 7


def page_rows(spark, rows):
    return spark.createDataFrame([("b", *r) if len(r) == 3 else r for r in rows], uploads.PAGE_SCHEMA)


def test_pages_are_joined_in_order_and_empty_ones_count(spark):
    df = page_rows(spark, [("a", 2, "two \n"), ("a", 0, " zero"), ("a", 1, None), ("b", 0, " \n"), ("a", 2, "two \n")])
    got = {r["source_key"]: r for r in P.assemble_pages(df).collect()}
    assert (got["a"]["text"], got["a"]["num_pages"], got["a"]["char_count"]) == ("zero\n\ntwo", 3, 9)
    assert got["a"]["error"] is None and got["b"]["error"] == P.NO_TEXT


def versions(spark, rows):
    schema = uploads.PAGE_SCHEMA + ", arrival int"
    return spark.createDataFrame([("b", *r) for r in rows], schema)


def test_the_last_version_of_a_page_counts(spark):
    rows = [("a", 0, "old text", 1), ("a", 0, "new text", 2), ("a", 0, "new text", 2), ("a", 0, "older", 0), ("a", 1, "one", 5),
            ("a", 2, "zz", 3), ("a", 2, None, 4), ("b", 0, "tie a", 1), ("b", 0, "tie b", 1), ("c", 0, "x", None), ("c", 0, "y", 0)]
    df = versions(spark, rows)
    for pages in (df, P.latest_pages(df), P.latest_pages(df.repartition(7))):
        got = {r["source_key"]: (r["text"], r["num_pages"]) for r in P.assemble_pages(pages).collect()}
        assert got == {"a": ("new text\none", 3), "b": ("tie b", 1), "c": ("y", 1)}
    assert sorted((r["source_key"], r["page_no"]) for r in P.latest_pages(df).collect()) == [
        ("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0)]


def test_pages_without_a_number_are_a_list(spark):
    rows = [("a", None, "same", 2), ("a", None, "same", 2), ("a", None, "before", 1), ("a", 7, "numbered", 9), ("b", None, None, 1)]
    df = versions(spark, rows)
    for pages in (df, P.latest_pages(df)):
        got = {r["source_key"]: (r["text"], r["num_pages"], r["error"]) for r in P.assemble_pages(pages).collect()}
        assert got == {"a": ("numbered\nbefore\nsame\nsame", 4, None), "b": ("", 1, P.NO_TEXT)}
    plain = P.assemble_pages(df.drop("arrival")).filter("source_key = 'a'").first()
    assert (plain["text"], plain["num_pages"]) == ("numbered\nbefore\nsame\nsame", 4)


def test_versions_are_compared_before_they_are_shuffled(spark):
    df = versions(spark, [("a", 0, f"v{i}", i) for i in range(500)])
    plan = P.latest_pages(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "partial_max" in plan
    assert [(r["page_text"], r["arrival"]) for r in P.latest_pages(df).collect()] == [("v499", 499)]


def test_a_notification_without_a_bucket_is_one_reject(spark):
    bodies = ['{"Records": [{"s3": {"object": {"key": "a.pdf"}}}]}',
              '{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "c.pdf"}}}]}']
    events = spark.createDataFrame([(b,) for b in bodies], "body string")
    found = pipeline.with_unreadable(pipeline.documents_for(
        uploads.pdf_uploads(events), page_rows(spark, [("c.pdf", 0, "text")])), events)
    assert [(r["source_bucket"], r["source_key"], r["error"]) for r in found.orderBy("source_key").collect()] == [
        (None, None, uploads.NO_OBJECT), ("b", "c.pdf", None)]


def test_a_key_in_two_buckets_is_two_documents(spark):
    pages = page_rows(spark, [("b1", "x.pdf", 0, "one"), ("b2", "x.pdf", 0, "two"), ("b2", "y.pdf", 0, "other")])
    wanted = spark.createDataFrame([("b1", "x.pdf"), ("b2", "x.pdf"), ("b3", "x.pdf")], "source_bucket string, source_key string")
    got = {r["source_bucket"]: (r["text"], r["num_pages"], r["error"]) for r in pipeline.documents_for(wanted, pages).collect()}
    assert got == {"b1": ("one", 1, None), "b2": ("two", 1, None), "b3": (None, None, P.MISSING)}
    assert [r["source_bucket"] for r in P.missing_inputs(wanted, pages).collect()] == ["b3"]


def test_unreadable_notifications(spark):
    bodies = ["{broken", '{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {}}}]}', '{"Event": "test"}',
              '{"Records": []}', '{"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": "a.pdf"}}}]}', "{broken"]
    found = uploads.unreadable_events(spark.createDataFrame([(b,) for b in bodies], "body string"))
    assert sorted(map(tuple, found.collect())) == sorted([(bodies[0], uploads.BROKEN), (bodies[1], uploads.NO_OBJECT)])


def test_a_hot_document_with_a_third_of_all_pages(spark):
    rows = [("hot", i, f"p{i}") for i in range(5000)] + [(f"d{i}", 0, "x") for i in range(10_000)]
    got = {r["source_key"]: r for r in P.assemble_pages(page_rows(spark, rows)).collect()}
    assert got["hot"]["text"] == "\n".join(f"p{i}" for i in range(5000)) and len(got) == 10_001


@pytest.mark.parametrize("key, decoded, kept", [
    ("My+Doc%201.PDF", "My Doc 1.PDF", True), ("notes.txt", "notes.txt", False),
    ("a%2fb%zz.pdf", "a/b%zz.pdf", True), ("%C3%BC.pdf", "ü.pdf", True), ("100%.pdf", "100%.pdf", True),
])
def test_events(spark, key, decoded, kept):
    body = json.dumps({"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": key}}}]})
    df = spark.createDataFrame([(body,), ("{}",), ('{"Records": []}',), ("broken",)], "body string")
    rows = uploads.unnest_events(df).collect()
    assert [(r["source_bucket"], r["source_key"], r["accepted"]) for r in rows] == [("b", decoded, kept)]
