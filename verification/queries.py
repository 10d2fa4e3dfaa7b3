"""Every operator as a query over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketmill.functions import extraction as X
from docketmill.functions import text as T
from docketmill.operators import billing, keywords, paged, pages, reports, terms
from docketmill.operators import classify as C
from docketmill.operators import metadata as M
from docketmill.operators import summarize as S
from docketmill.operators.rows import spread
from docketmill.plans import pipeline, records
from docketmill.rules import EMAIL, PHONE, RuleSet
from docketmill.session import new_folder
from docketmill.sources import sinks, uploads
from docketmill.streaming import arrivals
from verification import business_text


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text")


def business(spark, sf) -> DataFrame:
    names = ("lineitem", "orders", "customer", "nation", "region")
    return business_text.business_documents({n: table(spark, sf, n) for n in names})


def invoices(spark, sf) -> DataFrame:
    return business_text.invoices(
        table(spark, sf, "lineitem"), table(spark, sf, "orders"), table(spark, sf, "customer"))


def segment_revenue(spark, sf) -> DataFrame:
    return billing.segment_revenue(*[
        table(spark, sf, n) for n in ("lineitem", "orders", "customer", "nation", "region")])


def sales_reports(spark, sf) -> DataFrame:
    return business_text.sales_reports(segment_revenue(spark, sf))


def applications(spark, sf) -> DataFrame:
    return business_text.applications(table(spark, sf, "customer"))


def chat_key() -> Column:
    return F.concat(F.lit("chats/"), F.col("conv_id").cast("string"), F.lit(".pdf"))


def chat_pages(spark, sf) -> DataFrame:
    """Conversations as a page table: a conversation is a document, a turn a page."""
    return table(spark, sf, "conversations").select(
        F.lit("chats").alias("source_bucket"),
        chat_key().alias("source_key"),
        F.col("turn").cast("int").alias("page_no"),
        F.col("text").alias("page_text"),
    )


def order_uploads(spark, sf) -> DataFrame:
    """An upload for every order."""
    return table(spark, sf, "orders").select(
        F.lit(business_text.BUCKET).alias("source_bucket"),
        F.concat(F.lit("invoices/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("source_key"))


def order_pages(spark, sf) -> DataFrame:
    """The page of every invoice; of orders without lines, finished ones have a page without
    text, and the others none."""
    written = invoices(spark, sf).select(
        "source_bucket", "source_key", F.lit(0).alias("page_no"), F.col("text").alias("page_text"))
    finished = order_uploads(spark, sf).join(
        table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
            F.concat(F.lit("invoices/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("source_key")),
        "source_key", "left_semi")
    blank = finished.join(written.select("source_key"), "source_key", "left_anti").select(
        "source_bucket", "source_key", F.lit(0).alias("page_no"), F.lit(None).cast("string").alias("page_text"))
    return written.unionByName(blank)


def plain_and_business(spark, sf) -> DataFrame:
    """Business documents and plain ones together, so that every branch occurs."""
    plain = documents(spark, sf).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return business(spark, sf).select("doc_id", "text").unionByName(plain)


def upload_events(spark, sf) -> DataFrame:
    """Web pages as upload notifications of two records: the page and its copy in capitals."""
    url = F.col("url")
    host = F.regexp_extract(url, "^https?://([^/]+)/", 1)
    path = F.regexp_extract(url, "^https?://[^/]+/(.*)$", 1)
    suffix = F.when(F.endswith(url, F.lit(".html")), F.lit("")).otherwise(F.lit(".pdf"))

    def record(key: Column) -> Column:
        return F.struct(F.struct(
            F.struct(host.alias("name")).alias("bucket"),
            F.struct(F.replace(key, F.lit("/"), F.lit("%2F")).alias("key")).alias("object"),
        ).alias("s3"))

    first = record(F.concat(F.lit("My+"), path, suffix))
    second = record(F.concat(F.upper(path), F.lit("+%C3%BC%2"), F.upper(suffix)))
    body = F.to_json(F.struct(F.array(first, second).alias("Records")))
    return table(spark, sf, "pages").select(body.alias("body"))


# --- terms -------------------------------------------------------------------

def token_rows(spark, sf):
    return terms.token_rows(documents(spark, sf))


def term_counts(spark, sf):
    return terms.term_counts(documents(spark, sf))


def bigrams(spark, sf):
    return terms.bigrams(documents(spark, sf))


def doc_frequency(spark, sf):
    return terms.doc_frequency(documents(spark, sf))


def idf(spark, sf):
    return terms.idf(documents(spark, sf)).withColumn("idf", F.round("idf", 9))


def tfidf(spark, sf):
    weighted = terms.tfidf(documents(spark, sf), terms.rule_idf(spark), broadcast_weights=True)
    return weighted.withColumn("weight", F.round("weight", 10))


def corpus_tfidf(spark, sf):
    return terms.corpus_tfidf(documents(spark, sf)).withColumn("weight", F.round("weight", 9))


def cosine(spark, sf):
    return terms.cosine(documents(spark, sf)).withColumn("similarity", F.round("similarity", 8))


# --- classification ----------------------------------------------------------

def _scores(df: DataFrame, *kinds: str) -> DataFrame:
    return df.select("doc_id", *C.flat_scores(df, kinds))


def alias_scores(spark, sf):
    return _scores(C.alias_scores(plain_and_business(spark, sf)), "alias_scores")


def structural_scores(spark, sf):
    return _scores(C.structural_scores(plain_and_business(spark, sf)), "structural_scores")


def combined_scores(spark, sf):
    df = C.combined_scores(documents(spark, sf))
    cols = [F.round(F.col("scores")[n], 8).alias(f"score_{n}") for n in df.schema["scores"].dataType.names]
    return df.select("doc_id", *cols)


def _classified(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "category", "best_match", "confidence", *C.flat_scores(df))


def classify(spark, sf):
    return _classified(C.classify(documents(spark, sf)))


def category_counts(spark, sf):
    return C.category_counts(C.classify(documents(spark, sf)))


def business_scores(spark, sf):
    return _classified(C.classify(business(spark, sf).select("doc_id", "text")))


def business_categories(spark, sf):
    return C.category_counts(C.classify(business(spark, sf)))


# --- lines, sentences, values ------------------------------------------------

def lines(spark, sf):
    return keywords.lines(documents(spark, sf))


def sentences(spark, sf):
    return S.sentences(documents(spark, sf))


def sentence_scores(spark, sf):
    return S.sentence_scores(documents(spark, sf))


def summary_tokens(spark, sf):
    return S.summary_tokens(documents(spark, sf))


def summarize(spark, sf):
    return S.summarize(documents(spark, sf)).select("doc_id", "summary")


def emails(spark, sf):
    return documents(spark, sf).select("doc_id", T.first_email(F.col("text"), EMAIL).alias("email"))


def phones(spark, sf):
    return documents(spark, sf).select("doc_id", T.first_phone(F.col("text"), PHONE).alias("phone"))


def currency_flag(spark, sf):
    return documents(spark, sf).select("doc_id", X.currency(F.col("text")).alias("currency"))


def largest_amounts(spark, sf):
    return plain_and_business(spark, sf).select(
        "doc_id", X.largest_dollar_amount(F.col("text")).alias("largest_amount"))


# --- order tables ------------------------------------------------------------

def _as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def invoice_totals(spark, sf):
    return _as_double(billing.invoice_totals(table(spark, sf, "lineitem")), "subtotal", "tax", "total")


def revenue_breakdown(spark, sf):
    return _as_double(billing.revenue_breakdown(segment_revenue(spark, sf)), "revenue")


def business_documents(spark, sf):
    return business(spark, sf)


# --- extraction --------------------------------------------------------------

def invoice_metadata(spark, sf):
    return M.invoice_metadata(invoices(spark, sf)).drop("text", "source_bucket", "source_key")


def sales_report_metadata(spark, sf):
    return M.sales_report_metadata(sales_reports(spark, sf)).drop("text", "source_bucket", "source_key")


def application_metadata(spark, sf):
    return M.application_metadata(applications(spark, sf)).drop("text", "source_bucket", "source_key")


def metadata(spark, sf):
    return M.metadata(C.classify(plain_and_business(spark, sf))).select("doc_id", "category", "metadata")


def keyword_matches(spark, sf):
    return keywords.keyword_matches(business(spark, sf))


def keyword_fields(spark, sf):
    return keywords.keyword_fields(business(spark, sf))


# --- ingest ------------------------------------------------------------------

def events_unnest(spark, sf):
    return uploads.unnest_events(upload_events(spark, sf)).drop("event_time")


def pdf_uploads(spark, sf):
    return uploads.pdf_uploads(upload_events(spark, sf))


def assemble_pages(spark, sf):
    return pages.assemble_pages(chat_pages(spark, sf)).drop("extractor", "error")


def quarantine_empty(spark, sf):
    found = pages.assemble_pages(order_pages(spark, sf))
    return pages.quarantined(found).select("source_bucket", "source_key", "num_pages", "error")


def missing_inputs(spark, sf):
    return pages.missing_inputs(order_uploads(spark, sf), order_pages(spark, sf))


def two_buckets(spark, sf):
    """The same keys in two buckets, with other texts in the second, and an upload in a third."""
    first = chat_pages(spark, sf)
    second = first.withColumns({"source_bucket": F.lit("copies"), "page_text": F.translate("page_text", "e", "3")})
    both = first.unionByName(second)
    third = first.withColumn("source_bucket", F.lit("lost"))
    uploaded = both.unionByName(third).select("source_bucket", "source_key").distinct()
    return pipeline.documents_for(uploaded, both).select(
        "source_bucket", "source_key", "text", "num_pages", "char_count", "error")


def events_rejected(spark, sf):
    """Web pages among notifications are none that can be read."""
    raw = table(spark, sf, "pages").select(F.col("html").alias("body"))
    return uploads.unreadable_events(upload_events(spark, sf).unionByName(raw))


def page_versions(spark, sf):
    """Conversations whose pages are written again, delivered again, or have no number."""
    turn = F.col("page_no")
    first = chat_pages(spark, sf).withColumn("arrival", F.lit(0))
    again = first.filter(turn % 4 == 1).withColumn("arrival", F.lit(1))
    changed = first.filter(turn % 3 == 0).withColumns({"arrival": F.lit(1), "page_text": F.translate("page_text", "e", "3")})
    last = first.filter(turn % 6 == 0).withColumns({
        "arrival": F.lit(2), "page_text": F.concat("page_text", F.lit(" (last)"))})
    notes = first.filter(turn % 5 == 1).withColumns({
        "arrival": turn, "page_no": F.lit(None).cast("int"), "page_text": F.concat(F.lit("note "), (turn % 2).cast("string"))})
    found = first
    for more in (again, changed, last, notes, notes):
        found = found.unionByName(more)
    return pages.assemble_pages(found).select("source_key", "text", "num_pages", "char_count")


def latest_pages(spark, sf):
    """The same rewritten pages, one row a page."""
    first = chat_pages(spark, sf).withColumn("arrival", F.lit(0))
    found = first
    for n in (1, 2, 3):
        found = found.unionByName(first.filter(F.col("page_no") % (n + 1) == 0).withColumns({
            "arrival": F.lit(n), "page_text": F.concat("page_text", F.lit(f" v{n}"))}))
    return pages.latest_pages(found).drop("source_bucket")


def upload_summary(spark, sf):
    """Notifications of web pages, each with one that lacks a bucket; the copies in capitals have no page."""
    url = F.col("url")
    path = F.regexp_extract(url, "^https?://[^/]+/(.*)$", 1)
    nameless = table(spark, sf, "pages").select(F.to_json(F.struct(F.array(F.struct(F.struct(
        F.struct(F.concat(path, F.lit(".pdf")).alias("key")).alias("object")).alias("s3"))).alias("Records"))).alias("body"))
    events = upload_events(spark, sf).unionByName(nameless)
    written = uploads.pdf_uploads(events).filter("source_key like 'My %'").withColumns({
        "page_no": F.lit(0), "page_text": F.lit("some text")})
    found = pipeline.documents_for(uploads.pdf_uploads(events), written)
    return reports.run_summary(pipeline.with_unreadable(found, events))


def _announced(spark, sf, pages_: DataFrame) -> str:
    """Where the results are of a stream in which every conversation is announced twice, in four batches."""
    keys = table(spark, sf, "conversations").select("conv_id", chat_key().alias("key")).distinct()
    record = F.struct(F.struct(
        F.struct(F.lit("chats").alias("name")).alias("bucket"), F.struct(F.col("key")).alias("object")).alias("s3"))
    # A notification has a bounded number of records.
    first = keys.select(F.floor(F.col("conv_id") / 64).cast("string").alias("name"), record.alias("r"))
    second = keys.select(F.concat(F.lit("again "), F.floor(F.col("conv_id") / 128)).alias("name"), record.alias("r"))
    bodies = first.unionByName(second).groupBy("name").agg(F.collect_list("r").alias("Records")).select(
        F.to_json(F.struct("Records")).alias("body"))
    source, out = new_folder(spark, "notifications"), new_folder(spark, "stream")
    bodies.write.option("maxRecordsPerFile", 1).text(source)
    a_batch = -(-bodies.count() // 4)
    arrivals.run_uploads_stream(
        arrivals.event_stream(spark, source, a_batch), pages_, source, out, new_folder(spark, "offsets")).awaitTermination()
    return out


def stream_records(spark, sf):
    done, bad = arrivals.read_stream_results(spark, _announced(spark, sf, chat_pages(spark, sf)))
    return done.select("source_bucket", "source_key", "num_pages", "char_count", F.lit(None).cast("string").alias("error")).unionByName(
        bad.select("source_bucket", "source_key", "num_pages", F.lit(None).cast("bigint").alias("char_count"), "error"))


def stream_totals(spark, sf):
    """Totals of a stream in which a fifth of the conversations have no pages, and fail twice."""
    some = chat_pages(spark, sf).filter(F.regexp_extract("source_key", "[0-9]+", 0).cast("bigint") % 5 != 0)
    return arrivals.read_totals(spark, _announced(spark, sf, some))


def manifest_changes(spark, sf):
    """Web pages as objects before and after some were removed, written again or added."""
    n = F.col("page_id")
    before = table(spark, sf, "pages").select(
        n, F.lit("web").alias("source_bucket"), F.concat(F.lit("p/"), n.cast("string"), F.lit(".pdf")).alias("source_key"),
        F.length("html").cast("bigint").alias("length"), F.timestamp_seconds(n).alias("modification_time"))
    kept_ = before.filter(n % 5 != 0).withColumns({
        "length": F.col("length") + F.when(n % 5 == 1, 1).otherwise(0),
        "modification_time": F.when(n % 5 == 2, F.timestamp_seconds(n + 1)).otherwise(F.col("modification_time"))})
    added = before.filter(n % 7 == 3).withColumn("source_key", F.concat(F.lit("new/"), "source_key"))
    return uploads.manifest_changes(before.drop("page_id"), kept_.unionByName(added).unionByName(added).drop("page_id"))


# --- branches that the business documents do not take ------------------------

def receipts(spark, sf) -> DataFrame:
    """`(doc_id, text)`: a receipt per customer, with repeated and conflicting values, and labels without one."""
    n = F.col("c_custkey")

    def line(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    cents = line("$1.", n % 90 + 10)
    text = F.concat_ws(
        "\n", F.lit("RECEIPT"), line("Company Name: Shop ", n % 7), line("Served By: Clerk ", n % 5),
        line("Cashier:  Clerk  ", n % 5), line("Quarter: Q", n % 4 + 1, " 2001"), F.lit("Gross Revenue"),
        line("$", n, ".50"), line("Tax: ", cents), line("Tax: ", cents), line("GST - $", n % 9 + 1, ".25"),
        F.lit("Sales Tax (5%): $3.00"), F.lit("Phone: none"), F.lit("Tax: free"), F.lit("Vendor:"))
    buyers = spread(table(spark, sf, "customer").select("c_custkey"), "c_custkey")
    return buyers.select(line("receipt-", n).alias("doc_id"), text.alias("text"))


def receipt_matches(spark, sf):
    return keywords.keyword_matches(receipts(spark, sf))


def receipt_fields(spark, sf):
    return keywords.keyword_fields(receipts(spark, sf))


def plain_summaries(spark, sf):
    """Texts of 0 to 6 sentences, none with a word that counts."""
    n = F.col("doc_id")
    said = F.transform(F.sequence(F.lit(1), (n % 7).cast("int")), lambda i: F.concat(
        F.lit("It was of the "), n.cast("string"), F.lit(" and "), i.cast("string"), F.lit(".")))
    text = F.when(n % 7 == 0, F.lit("")).otherwise(F.array_join(said, " "))
    return S.summarize(documents(spark, sf).select("doc_id", text.alias("text"))).select("doc_id", "summary")


def untotalled_reports(spark, sf):
    """Sales reports without a TOTAL line and with the sum in words only: the largest amount counts."""
    text = F.replace(F.replace("text", F.lit("TOTAL $"), F.lit("SUM EUR ")), F.lit("came to $"), F.lit("came to EUR "))
    reports_ = sales_reports(spark, sf).select("doc_id", text.alias("text"))
    return M.sales_report_metadata(reports_).select("doc_id", "total_revenue", "currency")


def sink_records(spark, sf):
    """Records of a tenth of the applications as they are read back from CSV, and whether JSON says the same."""
    some = applications(spark, sf).filter(F.regexp_extract("doc_id", "[0-9]+", 0).cast("bigint") % 10 == 7)
    out = new_folder(spark, "results")
    pipeline.run(pages.from_text(some), out)
    from_csv, from_json = sinks.read_results(spark, f"{out}/results")
    keys = ["document_id", "filename", "source_key", "category", "confidence", "num_pages", "char_count", "summary", "processed_at"]
    same = from_json.select(*keys, F.lit(True).alias("in_json"))
    recent = F.abs(F.unix_timestamp() - F.unix_timestamp(F.to_timestamp("processed_at"))) < 86_400
    formed = F.col("processed_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$")
    return from_csv.join(same, keys, "left").withColumn("timed", formed & recent).drop("processed_at", "source_path")


# --- pages that never meet ---------------------------------------------------

def _cut(docs: DataFrame, separator: str, size: int) -> DataFrame:
    """`(doc_id, page_no, page_text)`: a page for every `size` pieces of a text between separators."""
    def pages_of(parts: Column) -> Column:
        starts = F.sequence(F.lit(0), F.ceil(F.size(parts) / size).cast("int") - 1)
        return F.transform(starts, lambda i: F.array_join(F.slice(parts, i * size + 1, size), separator))

    # Split once a text, not once a page.
    cut = T.bind(F.split("text", separator), pages_of)
    rows = docs.select("doc_id", F.posexplode_outer(cut).alias("page_no", "page_text"))
    return rows.withColumn("page_no", F.coalesce("page_no", F.lit(0)))


def document_pages(spark, sf) -> DataFrame:
    """Documents in pages of 25 words, so that most sentences and many word pairs cross a page edge."""
    return _cut(documents(spark, sf), " ", 25)


def paged_cosine(spark, sf):
    found = paged.cosine(document_pages(spark, sf), key=["doc_id"])
    return found.withColumn("similarity", F.round("similarity", 8))


def paged_sentence_scores(spark, sf):
    return paged.sentence_scores(document_pages(spark, sf), key=["doc_id"])


def paged_summaries(spark, sf):
    return paged.summarize(document_pages(spark, sf), key=["doc_id"])


def paged_keyword_matches(spark, sf):
    """Business documents in pages of five lines: `Bill To:` is the last line of one."""
    return paged.keyword_matches(_cut(business(spark, sf), "\n", 5), key=["doc_id"])


#: Labels that hold the signs at which the others end.
SIGNED = RuleSet(field_aliases={
    "invoice_number": ["invoice-no", "invoice-no (ours)", "invoice number"],
    "customer_name": ["bill-to"],
    "email": ["e-mail"],
    "employer": ["employer", "employer: since 2001"],
})


def signed_labels(spark, sf):
    """Business documents with such labels, some lines naming two of them."""
    text = F.col("text")
    for plain, signed in (("Invoice Number: ", "Invoice-No (ours): "), ("Bill To:", " BILL-to -"),
                          ("Email Address: ", "E-Mail: "), ("Employer: ", "Employer:  since 2001 - ")):
        text = F.replace(text, F.lit(plain), F.lit(signed))
    return keywords.keyword_matches(business(spark, sf).select("doc_id", text.alias("text")), SIGNED).drop("number_value")


# --- records -----------------------------------------------------------------

def _business_records(spark, sf) -> DataFrame:
    return pipeline.records(pages.from_text(business(spark, sf)))


def business_records(spark, sf):
    return _business_records(spark, sf).drop("processed_at")


def records_csv(spark, sf):
    return records.csv_rows(_business_records(spark, sf)).drop("processed_at")


def records_json(spark, sf):
    fixed = _business_records(spark, sf).withColumn("processed_at", F.lit("2025-01-01T00:00:00+00:00"))
    return records.json_lines(fixed)


def processed_list(spark, sf):
    return reports.processed_list(_business_records(spark, sf))


def audit_view(spark, sf):
    return reports.audit_view(_business_records(spark, sf))


def _order_outcomes(spark, sf) -> DataFrame:
    return pipeline.outcomes(pipeline.documents_for(order_uploads(spark, sf), order_pages(spark, sf)))


def run_summary(spark, sf):
    return reports.run_summary(_order_outcomes(spark, sf))


def rejects(spark, sf):
    return pages.quarantined(_order_outcomes(spark, sf)).select("filename", "s3_uri", "num_pages", "error")


def output_parity(spark, sf):
    """Uploads against the rows of the CSV output and what is parsed from the JSON lines."""
    done = pages.accepted(_order_outcomes(spark, sf))
    lines_of_json = records.json_lines(done)
    from_json = lines_of_json.select(F.json_tuple("value", "source_bucket", "source_key").alias(
        "source_bucket", "source_key"))
    return reports.output_parity(order_uploads(spark, sf), records.csv_rows(done), from_json)


def output_parity_files(spark, sf):
    """Uploads of a twentieth of the orders against the records in the files of both sinks."""
    some = F.col("o_orderkey") % 20 == 3
    wanted = table(spark, sf, "orders").filter(some).select(
        F.lit(business_text.BUCKET).alias("source_bucket"),
        F.concat(F.lit("invoices/"), F.col("o_orderkey").cast("string"), F.lit(".pdf")).alias("source_key"))
    out = new_folder(spark, "results")
    pipeline.run(pipeline.documents_for(wanted, order_pages(spark, sf)), out)
    from_csv, from_json = sinks.read_results(spark, f"{out}/results")
    return reports.output_parity(wanted, from_csv, from_json)


QUERIES = {
    "token_rows": token_rows,
    "term_counts": term_counts,
    "bigrams": bigrams,
    "doc_frequency": doc_frequency,
    "idf": idf,
    "tfidf": tfidf,
    "corpus_tfidf": corpus_tfidf,
    "cosine": cosine,
    "alias_scores": alias_scores,
    "structural_scores": structural_scores,
    "combined_scores": combined_scores,
    "classify": classify,
    "category_counts": category_counts,
    "business_scores": business_scores,
    "business_categories": business_categories,
    "lines": lines,
    "sentences": sentences,
    "sentence_scores": sentence_scores,
    "summary_tokens": summary_tokens,
    "summarize": summarize,
    "emails": emails,
    "phones": phones,
    "currency_flag": currency_flag,
    "largest_amounts": largest_amounts,
    "invoice_totals": invoice_totals,
    "revenue_breakdown": revenue_breakdown,
    "business_documents": business_documents,
    "invoice_metadata": invoice_metadata,
    "sales_report_metadata": sales_report_metadata,
    "application_metadata": application_metadata,
    "metadata": metadata,
    "keyword_matches": keyword_matches,
    "keyword_fields": keyword_fields,
    "events_unnest": events_unnest,
    "pdf_uploads": pdf_uploads,
    "assemble_pages": assemble_pages,
    "quarantine_empty": quarantine_empty,
    "missing_inputs": missing_inputs,
    "two_buckets": two_buckets,
    "events_rejected": events_rejected,
    "receipt_matches": receipt_matches,
    "receipt_fields": receipt_fields,
    "plain_summaries": plain_summaries,
    "untotalled_reports": untotalled_reports,
    "sink_records": sink_records,
    "page_versions": page_versions,
    "latest_pages": latest_pages,
    "upload_summary": upload_summary,
    "stream_records": stream_records,
    "stream_totals": stream_totals,
    "manifest_changes": manifest_changes,
    "paged_cosine": paged_cosine,
    "paged_sentence_scores": paged_sentence_scores,
    "paged_summaries": paged_summaries,
    "paged_keyword_matches": paged_keyword_matches,
    "signed_labels": signed_labels,
    "records": business_records,
    "records_csv": records_csv,
    "records_json": records_json,
    "processed_list": processed_list,
    "audit_view": audit_view,
    "run_summary": run_summary,
    "rejects": rejects,
    "output_parity": output_parity,
    "output_parity_files": output_parity_files,
}
