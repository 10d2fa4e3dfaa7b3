"""DuckDB twins of the queries, written relationally and without the library.

They share only the rule constants with it.  Extraction answers come straight
from the order tables, not from the text.
"""

from __future__ import annotations

from docketmill.rules import (
    CATEGORY_FIELDS, FIELD_ALIASES, LAYOUT_RULES, MONEY_FIELDS, PHRASE_RULES, PROTOTYPES, STOPWORDS,
)

CATEGORIES = list(PROTOTYPES)
SHORT = {"Invoice": "invoice", "Sales Report": "sales_report", "Customer Application": "customer_application"}


def s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- source texts ------------------------------------------------------------

DOCS = "src AS (SELECT doc_id, text FROM documents)"

ORDER_SUMS = """
order_sums AS (
  SELECT l_orderkey AS k, count(*) AS lines, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS subtotal,
         sum(l_quantity) AS units
  FROM lineitem GROUP BY 1),
order_tax AS (SELECT *, round(subtotal * 0.17::DECIMAL(3,2), 2) AS tax FROM order_sums),
order_head AS (
  SELECT t.*, o_custkey AS c, strftime(o_orderdate, '%Y-%m-%d') AS day, year(o_orderdate) AS y, c_name
  FROM order_tax t JOIN orders ON o_orderkey = k JOIN customer ON c_custkey = o_custkey)"""

ITEMS = """
item_sums AS (
  SELECT l_orderkey AS k, coalesce(CASE WHEN l_returnflag IN ('A','N','R') THEN l_returnflag END, 'Z') AS flag,
         sum(l_quantity)::BIGINT AS q, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS a
  FROM lineitem GROUP BY 1, 2),
item_lines AS (
  SELECT k, flag, CASE flag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'New' WHEN 'R' THEN 'Returned' ELSE 'Other' END
    || ' items ' || q || ' $' || ((a * 100)::BIGINT // q // 100) || '.'
    || lpad(((a * 100)::BIGINT // q % 100)::VARCHAR, 2, '0') || ' $' || a::DECIMAL(18,2) AS line
  FROM item_sums WHERE q > 0),
item_text AS (SELECT k, string_agg(line, chr(10) ORDER BY flag) AS items, count(*) AS n_items
  FROM item_lines GROUP BY k)"""

INVOICES = ORDER_SUMS + "," + ITEMS + """,
invoices AS (
  SELECT 'invoice-' || k AS doc_id, 'invoices/' || k || '.pdf' AS source_key, concat_ws(chr(10),
    'INVOICE', 'Invoice Number: INV-' || y || '-' || k, 'Invoice Date: ' || day, 'Due Date: ' || day, 'Bill To:',
    replace(c_name, '#', ' '), (c % 90 + 10) || ' Harbor Road', 'Email: billing' || c || '@example.com',
    'Description Qty Unit Price Total', items, 'Subtotal: $' || subtotal::DECIMAL(18,2),
    'Tax (17%): $' || tax::DECIMAL(18,2), 'Total Amount Due: $' || (subtotal + tax)::DECIMAL(18,2),
    'Payment Terms: Net 30 days. Please pay by the date above. Late payments carry a fee.') AS text
  FROM order_head LEFT JOIN item_text USING (k))"""

REVENUE = """
sold AS (
  SELECT r_name AS region, date_trunc('quarter', o_orderdate)::DATE AS q_start, c_mktsegment AS product_line,
         l_quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
revenue AS (
  SELECT region, q_start, 'Q' || quarter(q_start) || ' ' || year(q_start) AS quarter, product_line,
         sum(l_quantity) AS units, sum(price) AS revenue
  FROM sold GROUP BY ALL)"""

REPORTS = REVENUE + """,
report_heads AS (
  SELECT region, quarter, q_start, sum(revenue) AS total,
    quarter || ' (' || CASE quarter(q_start) WHEN 1 THEN 'January - March' WHEN 2 THEN 'April - June'
      WHEN 3 THEN 'July - September' ELSE 'October - December' END || ')' AS period,
    lower(replace(region || '-' || quarter, ' ', '-')) AS slug
  FROM revenue GROUP BY region, quarter, q_start),
report_lines AS (
  SELECT r.region, r.quarter, string_agg(product_line || ' ' || units::BIGINT || ' $'
    || format('{:,.2f}', revenue::DOUBLE) || ' ' || round(revenue * 100 / total, 1)::DECIMAL(5,1) || '%',
    chr(10) ORDER BY product_line) AS listed
  FROM revenue r JOIN report_heads h ON r.region = h.region AND r.quarter = h.quarter GROUP BY 1, 2),
reports AS (
  SELECT 'report-' || slug AS doc_id, 'reports/' || slug || '.pdf' AS source_key, concat_ws(chr(10),
    'QUARTERLY SALES REPORT', 'Reporting Period: ' || period, 'Region: ' || h.region,
    'Report Generated: ' || strftime(q_start + INTERVAL 3 MONTH, '%Y-%m-%d'), 'Executive Summary',
    'Orders from ' || h.region || ' in ' || h.quarter || ' are listed below. Total revenue came to $'
      || format('{:,.2f}', total::DOUBLE) || ' with year-over-year growth in most lines. '
      || 'Larger contracts and loyal buyers drove the performance of this quarter.',
    'Revenue Breakdown by Product Line', 'Product Line Units Sold Revenue % of Total', listed,
    'TOTAL $' || format('{:,.2f}', total::DOUBLE) || ' 100.0%', 'Key Observations',
    'Buyers returned more often than a year ago. Recommendations are to widen the product range. '
      || 'The forecast assumes that prices stay as they are.') AS text
  FROM report_heads h JOIN report_lines l ON h.region = l.region AND h.quarter = l.quarter)"""

APPLICANTS = """
applicants AS (
  SELECT c_custkey AS n, 'Alex ' || upper(name[1:1]) || name[2:] AS name, c_nationkey,
    strftime(DATE '2000-01-01' + (c_custkey % 700)::INT, '%Y-%m-%d') AS day,
    strftime(DATE '1950-01-01' + (c_custkey % 18000)::INT, '%Y-%m-%d') AS born,
    upper(c_mktsegment[1:1]) || lower(c_mktsegment[2:]) || ' Account' AS account,
    lpad((c_custkey % 10000000)::VARCHAR, 7, '0') AS num,
    '$' || format('{:,}', 30000 + c_custkey % 900 * 100) AS income,
    (30000 + c_custkey % 900 * 100)::DOUBLE AS income_value
  FROM (SELECT *, translate(c_custkey::VARCHAR, '0123456789', 'abcdefghij') AS name FROM customer))"""

APPLICATIONS = APPLICANTS + """,
applications AS (
  SELECT 'application-' || n AS doc_id, 'applications/' || n || '.pdf' AS source_key, concat_ws(chr(10),
    'CUSTOMER APPLICATION FORM', 'Application ID: APP-2000-' || n, 'Date of Application: ' || day,
    'Account Type Requested: ' || account, 'Personal Information', 'Full Name: ' || name,
    'Date of Birth: ' || born, 'National ID / SSN: 35202-' || num || '-8',
    'Email Address: applicant' || n || '@example.org', 'Phone Number: +92-300-' || num,
    'Residential Address: House ' || (n % 90 + 10) || ', Street 4', 'Employment Information',
    'Employer: Works ' || c_nationkey || ' Limited', 'Job Title: Analyst', 'Annual Income: ' || income,
    'Years Employed: ' || (n % 30 + 1),
    'I certify that these statements are true. I authorize the bank to check them with my employer.',
    'Signature: ' || name, 'Date: ' || day) AS text
  FROM applicants)"""

BUSINESS = f"""{INVOICES},{REPORTS},{APPLICATIONS},
business AS (SELECT * FROM invoices UNION ALL SELECT * FROM reports UNION ALL SELECT * FROM applications)"""

PLAIN_AND_BUSINESS = (
    BUSINESS + ",\nsrc AS (SELECT doc_id, text FROM business UNION ALL SELECT doc_id::VARCHAR, text FROM documents)")
BUSINESS_SRC = BUSINESS + ",\nsrc AS (SELECT doc_id, text FROM business)"

# --- terms -------------------------------------------------------------------

WORDS = "words AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z][a-z0-9]+') AS w FROM src)"
PAIRS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
COUNTS = f"""{WORDS},
counts AS (SELECT doc_id, token, count(*) AS cnt
  FROM (SELECT doc_id, unnest(list_concat(w, {PAIRS})) AS token FROM words) GROUP BY 1, 2)"""
DF = "df AS (SELECT token, count(*) AS df FROM counts GROUP BY token)"

PROTO = f"""
proto_text(category, ord, text) AS (VALUES {", ".join(f"({s(c)}, {i}, {s(t)})" for i, (c, t) in enumerate(PROTOTYPES.items()))}),
proto_words AS (SELECT category, regexp_extract_all(lower(text), '[a-z][a-z0-9]+') AS w FROM proto_text),
proto_counts AS (SELECT category, token, count(*) AS cnt
  FROM (SELECT category, unnest(list_concat(w, {PAIRS})) AS token FROM proto_words) GROUP BY 1, 2),
rule_idf AS (SELECT token, ln({1 + len(PROTOTYPES)}.0::DOUBLE / (1 + count(*))) + 1 AS idf FROM proto_counts GROUP BY token),
proto_vectors AS (SELECT category, token, cnt * idf AS w FROM proto_counts JOIN rule_idf USING (token)),
proto_norms AS (SELECT category, sqrt(sum(w * w)) AS norm FROM proto_vectors GROUP BY 1)"""

COSINE = f"""{COUNTS},{PROTO},
doc_vectors AS (SELECT doc_id, token, cnt * coalesce(idf, 1.0::DOUBLE) AS w FROM counts LEFT JOIN rule_idf USING (token)),
doc_norms AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM doc_vectors GROUP BY 1),
dots AS (SELECT doc_id, category, sum(d.w * p.w) AS dot FROM doc_vectors d JOIN proto_vectors p USING (token) GROUP BY 1, 2),
cosines AS (
  SELECT src.doc_id, n.category, coalesce(dot / (d.norm * n.norm), 0.0::DOUBLE) AS similarity
  FROM src CROSS JOIN proto_norms n LEFT JOIN doc_norms d USING (doc_id)
  LEFT JOIN dots ON dots.doc_id = src.doc_id AND dots.category = n.category)"""

# --- rules -------------------------------------------------------------------

# RE2 counts only ASCII letters as word characters, so accented letters are
# written as a plain one before the search.
PLAIN = "regexp_replace(text, '[À-ÖØ-öø-ɏ]', 'z', 'g')"


def rule_sum(rules: list[tuple[str, float]]) -> str:
    return " + ".join(
        f"(CASE WHEN regexp_matches(plain, {s(p if p.startswith('(?') else '(?i)' + p)}) THEN {w}::DOUBLE ELSE 0.0::DOUBLE END)"
        for p, w in rules
    )


RULES = f"""
plain_text AS MATERIALIZED (SELECT doc_id, {PLAIN} AS plain FROM src),
rule_scores AS MATERIALIZED (SELECT doc_id,
{", ".join(f"{rule_sum(PHRASE_RULES[c])} AS a_{SHORT[c]}" for c in CATEGORIES)},
{", ".join(f"{rule_sum(LAYOUT_RULES[c])} AS l_{SHORT[c]}" for c in CATEGORIES)}
FROM plain_text)"""


def _share(prefix: str, c: str) -> str:
    best = "greatest(" + ", ".join(f"{prefix}_{SHORT[x]}" for x in CATEGORIES) + ")"
    return f"({prefix}_{SHORT[c]} / (CASE WHEN {best} = 0 THEN 1.0::DOUBLE ELSE {best} END))"


COMBINED = f"""{COSINE},{RULES},
wide AS (SELECT doc_id, {", ".join(f"max(similarity) FILTER (category = {s(c)}) AS t_{SHORT[c]}" for c in CATEGORIES)}
  FROM cosines GROUP BY doc_id),
combined AS (SELECT *, {", ".join(
    f"0.40::DOUBLE * {_share('a', c)} + 0.35::DOUBLE * {_share('t', c)} + 0.25::DOUBLE * {_share('l', c)} AS c_{SHORT[c]}"
    for c in CATEGORIES)}
  FROM rule_scores JOIN wide USING (doc_id)),
long_scores AS (
  {" UNION ALL ".join(f"SELECT doc_id, {s(c)} AS category, {i} AS ord, c_{SHORT[c]} AS score FROM combined" for i, c in enumerate(CATEGORIES))}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, ord) AS rn FROM long_scores),
best AS (
  SELECT doc_id, max(category) FILTER (rn = 1) AS best_match, max(score) FILTER (rn = 1) AS top,
         max(score) FILTER (rn = 2) AS second FROM ranked GROUP BY doc_id),
classified AS (
  SELECT *, top - second AS margin,
    CASE WHEN top < 0.35::DOUBLE OR top - second < 0.12::DOUBLE THEN 'Unknown' ELSE best_match END AS category
  FROM best JOIN combined USING (doc_id))"""

SCORE_COLUMNS = ", ".join(
    f"round({p}_{SHORT[c]}, 4) AS {name}_{SHORT[c]}"
    for p, name in (("c", "score"), ("a", "alias"), ("t", "tfidf"), ("l", "structural")) for c in CATEGORIES
)
CLASSIFIED = f"SELECT doc_id, category, best_match, round(margin, 4) AS confidence, {SCORE_COLUMNS} FROM classified"

# --- sentences ---------------------------------------------------------------

STOP = ", ".join(s(w) for w in sorted(STOPWORDS))
SENTENCES = r"""
cleaned AS (SELECT doc_id, regexp_replace(trim(text, E' \t\n\r'), '\s+', ' ', 'g') AS t FROM src),
pieces AS (SELECT doc_id, string_split(regexp_replace(t, '([.!?])\s+([A-Z"''])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS p FROM cleaned),
kept AS (SELECT doc_id, list_filter(p, lambda x: len(string_split(x, ' ')) >= 4) AS k FROM pieces),
sents AS (SELECT doc_id, unnest(k) AS sentence, unnest(range(len(k))) AS sent_no, len(k) AS n FROM kept),
toks AS (SELECT doc_id, sent_no, lower(unnest(regexp_extract_all(sentence, '[A-Za-z][A-Za-z\-'']+'))) AS token FROM sents),
""" + f"""
good AS MATERIALIZED (SELECT * FROM toks WHERE len(token) > 2 AND token NOT IN ({STOP})),
freq AS (SELECT doc_id, token, count(*) AS f FROM good GROUP BY 1, 2),
scores AS (SELECT doc_id, sent_no, sum(f)::DOUBLE / count(*) AS score, count(*) AS words
  FROM good JOIN freq USING (doc_id, token) GROUP BY 1, 2)"""
SUMMARY = SENTENCES + """,
places AS (SELECT s.doc_id, s.sent_no, sentence, n,
    row_number() OVER (PARTITION BY s.doc_id ORDER BY score DESC NULLS LAST, s.sent_no) AS rank,
    count(score) OVER (PARTITION BY s.doc_id) AS scored, score
  FROM sents s LEFT JOIN scores USING (doc_id, sent_no)),
summaries AS (
  SELECT doc_id, string_agg(sentence, ' ' ORDER BY sent_no) AS summary FROM places
  WHERE n <= 3 OR (scored = 0 AND sent_no < 3) OR (score IS NOT NULL AND rank <= 3) GROUP BY doc_id)"""

# --- evidence of business documents ------------------------------------------

FIELD_ORDER = {f: i for i, f in enumerate(FIELD_ALIASES)}


def evidence_rows(source: str, prefix: str, rows: list[tuple[str, str, str, str]]) -> str:
    """Rows (field, label, raw SQL, line SQL) of one kind of document, numbered by field order."""
    rows = sorted(rows, key=lambda r: FIELD_ORDER[r[0]])
    return " UNION ALL ".join(
        f"SELECT {prefix} AS doc_id, {i} AS match_no, {s(f)} AS field, {s(label)} AS matched_label, {raw} AS raw_value, "
        + (f"NULL::VARCHAR AS text_value, replace(replace({raw}, '$', ''), ',', '')::DOUBLE AS number_value, "
           if f in MONEY_FIELDS else f"{raw} AS text_value, NULL::DOUBLE AS number_value, ")
        + f"{line} AS line_no FROM {source}"
        for i, (f, label, raw, line) in enumerate(rows)
    )


EVIDENCE = BUSINESS + """,
invoice_facts AS (SELECT h.*, n_items FROM order_head h LEFT JOIN item_text USING (k)),
evidence AS (""" + " UNION ALL ".join([
    evidence_rows("invoice_facts", "'invoice-' || k", [
        ("invoice_number", "invoice number", "'INV-' || y || '-' || k", "1"),
        ("invoice_date", "invoice date", "day", "2"),
        ("due_date", "due date", "day", "3"),
        ("customer_name", "bill to", "replace(c_name, '#', ' ')", "4"),
        ("email", "email", "'billing' || c || '@example.com'", "7"),
        ("subtotal", "subtotal", "'$' || subtotal::DECIMAL(18,2)", "9 + n_items"),
        ("tax", "tax", "'$' || tax::DECIMAL(18,2)", "10 + n_items"),
        ("total_amount_due", "total amount due", "'$' || (subtotal + tax)::DECIMAL(18,2)", "11 + n_items"),
    ]),
    evidence_rows("report_heads", "'report-' || slug", [
        ("reporting_period", "reporting period", "period", "1"),
        ("region", "region", "region", "2"),
    ]),
    evidence_rows("applicants", "'application-' || n", [
        ("application_id", "application id", "'APP-2000-' || n", "1"),
        ("account_type", "account type requested", "account", "3"),
        ("applicant_name", "full name", "name", "5"),
        ("date_of_birth", "date of birth", "born", "6"),
        ("email", "email address", "'applicant' || n || '@example.org'", "8"),
        ("phone", "phone number", "'+92-300-' || num", "9"),
        ("address", "residential address", "'House ' || (n % 90 + 10) || ', Street 4'", "10"),
        ("employer", "employer", "'Works ' || c_nationkey || ' Limited'", "12"),
        ("annual_income", "annual income", "income", "14"),
    ]),
]) + ")"


def json_number(x: str) -> str:
    """Shortest decimal text of a value with at most two decimals, always with a point."""
    d = f"regexp_replace(({x})::DECIMAL(18,2)::VARCHAR, '0$', '')"
    return d


VALUE = f"CASE WHEN number_value IS NOT NULL THEN {json_number('number_value')} ELSE '\"' || text_value || '\"' END"
KEYWORD_JSON = EVIDENCE + f""",
keyword_json AS (
  SELECT doc_id,
    '{{' || string_agg('"' || field || '": ' || {VALUE}, ', ' ORDER BY match_no) || '}}' AS keyword_fields,
    '{{' || string_agg('"' || field || '": [{{"matched_label": "' || matched_label || '", "raw_value": "' || raw_value
      || '", "normalized_value": ' || {VALUE} || '}}]', ', ' ORDER BY match_no) || '}}' AS keyword_matches
  FROM evidence GROUP BY doc_id)"""

INVOICE_FIELDS = {
    "invoice_number": "'INV-' || y || '-' || k", "invoice_date": "day", "due_date": "day",
    "bill_to": "replace(c_name, '#', ' ')", "customer_email": "'billing' || c || '@example.com'",
    "subtotal": "subtotal::DOUBLE", "tax": "tax::DOUBLE", "total_amount_due": "(subtotal + tax)::DOUBLE",
    "currency": "'USD'",
}
REPORT_FIELDS = {
    "reporting_period": "period", "quarter": "CASE WHEN year(q_start) >= 2000 THEN quarter END",
    "region": "region", "report_generated": "strftime(q_start + INTERVAL 3 MONTH, '%Y-%m-%d')",
    "total_revenue": "total::DOUBLE", "currency": "'USD'",
}
APPLICATION_FIELDS = {
    "application_id": "'APP-2000-' || n", "application_date": "day", "account_type": "account",
    "applicant_name": "name", "date_of_birth": "born", "national_id": "'35202-' || num || '-8'",
    "email": "'applicant' || n || '@example.org'", "phone": "'+92-300-' || num",
    "employer": "'Works ' || c_nationkey || ' Limited'", "job_title": "'Analyst'", "annual_income": "income",
}


def fields_select(key: str, fields: dict, source: str) -> str:
    return f"SELECT {key} AS doc_id, " + ", ".join(f"{v} AS {k}" for k, v in fields.items()) + f" FROM {source}"


def fields_json(fields: dict, null_names=()) -> str:
    parts = []
    for name, value in fields.items():
        if value.endswith("::DOUBLE"):
            text = json_number(value)
        else:
            text = f"coalesce('\"' || ({value}) || '\"', 'null')"
        parts.append(f"'\"{name}\": ' || {text}")
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


META = f"""
meta AS (
  SELECT 'invoice-' || k AS doc_id, {fields_json(INVOICE_FIELDS)} AS metadata FROM order_head
  UNION ALL SELECT 'report-' || slug, {fields_json(REPORT_FIELDS)} FROM report_heads
  UNION ALL SELECT 'application-' || n, {fields_json(APPLICATION_FIELDS)} FROM applicants)"""

# Plain documents: only the fields that need no label can be found in them.
EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PLAIN_EMAIL = f"nullif(regexp_extract(text, {s(EMAIL_RE)}), '')"
PLAIN_CURRENCY = "CASE WHEN contains(text, '$') THEN 'USD' END"
AMOUNTS = r"list_transform(regexp_extract_all(text, '\$\s?[\d,]+(\.\d{2})?'), lambda x: try_cast(trim(replace(replace(x, '$', ''), ',', '')) AS DOUBLE))"


def plain_json(category: str) -> str:
    parts = []
    for name, kind, pattern in CATEGORY_FIELDS[category]:
        if kind == "email":
            value = f"coalesce('\"' || {PLAIN_EMAIL} || '\"', 'null')"
        elif kind == "dollar_sign":
            value = f"coalesce('\"' || ({PLAIN_CURRENCY}) || '\"', 'null')"
        elif kind == "largest_money":
            value = f"coalesce({json_number('list_max(' + AMOUNTS + ')')}, 'null')"
        elif kind == "money":
            found = f"nullif(regexp_extract(text, {s('(?i)' + pattern)}, 1), '')"
            value = f"coalesce({json_number('replace(' + found + ', chr(44), chr(32))::DOUBLE')}, 'null')"
        else:
            found = f"nullif(trim(regexp_extract(text, {s('(?i)' + pattern)}, 1), E' \\t\\n\\r'), '')"
            if kind == "first_line":
                found = f"trim(split_part({found}, chr(10), 1))"
            value = f"coalesce('\"' || {found} || '\"', 'null')"
        parts.append(f"'\"{name}\": ' || {value}")
    return "'{' || " + " || ', ' || ".join(parts) + " || '}'"


WARNING = "'{\"warning\": \"No extractor registered for category ''' || category || '''.\"}'"

# --- pages and uploads -------------------------------------------------------

CHAT = "'chats/' || conv_id || '.pdf'"
ORDERED = """
uploads AS (
  SELECT 'business-inbox' AS source_bucket, 'invoices/' || o_orderkey || '.pdf' AS source_key, o_orderstatus,
    EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS has_lines
  FROM orders),
order_outcomes AS (
  SELECT source_bucket, source_key, CASE WHEN has_lines OR o_orderstatus = 'F' THEN 1 END AS num_pages,
    CASE WHEN NOT has_lines AND o_orderstatus = 'F' THEN 'no extractable text' WHEN NOT has_lines THEN 'missing input' END AS error
  FROM uploads)"""

EVENTS = r"""
parts AS (
  SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS host, regexp_extract(url, '^https?://[^/]+/(.*)$', 1) AS path,
    CASE WHEN url LIKE '%.html' THEN '' ELSE '.pdf' END AS suffix FROM pages),
event_rows AS (
  SELECT host AS source_bucket, 'My ' || path || suffix AS source_key FROM parts
  UNION ALL SELECT host, upper(path) || ' ü%2' || upper(suffix) FROM parts),
flagged AS (SELECT *, lower(source_key) LIKE '%.pdf' AS accepted FROM event_rows)"""

# --- records -----------------------------------------------------------------


def score_json(prefix: str) -> str:
    def num(c: str) -> str:
        text = f"rtrim(round({prefix}_{SHORT[c]}, 4)::DECIMAL(18,4)::VARCHAR, '0')"
        return f"CASE WHEN {text} LIKE '%.' THEN {text} || '0' ELSE {text} END"

    return "'{' || " + " || ', ' || ".join(f"'\"{c}\": ' || {num(c)}" for c in CATEGORIES) + " || '}'"


DIGEST = "sha256('s3://business-inbox/' || source_key || chr(10) || md5(text))"
RECORDS = f"""{KEYWORD_JSON},{META},
src AS (SELECT doc_id, text FROM business),
{COMBINED},{SUMMARY},
recs AS (
  SELECT concat_ws('-', d[1:8], d[9:12], d[13:16], d[17:20], d[21:32]) AS document_id,
    split_part(source_key, '/', -1) AS filename, 'business-inbox' AS source_bucket, source_key,
    NULL::VARCHAR AS source_path, 's3://business-inbox/' || source_key AS s3_uri, category,
    best_match AS best_category_match, round(margin, 4) AS confidence, 1 AS num_pages, len(b.text) AS char_count,
    'text' AS extractor, summary, metadata, keyword_fields, keyword_matches, {score_json('c')} AS category_scores,
    {score_json('a')} AS category_alias_scores, {score_json('t')} AS category_tfidf_scores,
    {score_json('l')} AS category_structural_scores
  FROM (SELECT *, {DIGEST} AS d FROM business) b JOIN classified USING (doc_id) JOIN meta USING (doc_id)
  JOIN keyword_json USING (doc_id) JOIN summaries USING (doc_id))"""
CONFIDENCE_TEXT = (
    "CASE WHEN rtrim(confidence::DECIMAL(18,4)::VARCHAR, '0') LIKE '%.' "
    "THEN rtrim(confidence::DECIMAL(18,4)::VARCHAR, '0') || '0' ELSE rtrim(confidence::DECIMAL(18,4)::VARCHAR, '0') END"
)


def quote_json(x: str) -> str:
    return f"'\"' || replace(replace({x}, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"') || '\"'"


JSON_RECORD = "'{' || " + " || ', ' || ".join(
    f"'\"{name}\": ' || {value}" for name, value in [
        ("document_id", quote_json("document_id")), ("filename", quote_json("filename")),
        ("source_bucket", quote_json("source_bucket")), ("source_key", quote_json("source_key")),
        ("s3_uri", quote_json("s3_uri")), ("category", quote_json("category")),
        ("best_category_match", quote_json("best_category_match")), ("confidence", CONFIDENCE_TEXT),
        ("category_scores", "category_scores"), ("category_alias_scores", "category_alias_scores"),
        ("category_tfidf_scores", "category_tfidf_scores"),
        ("category_structural_scores", "category_structural_scores"),
        ("num_pages", "num_pages"), ("char_count", "char_count"), ("extractor", quote_json("extractor")),
        ("summary", quote_json("summary")), ("metadata", "metadata"), ("keyword_fields", "keyword_fields"),
        ("keyword_matches", "keyword_matches"), ("processed_at", "'\"2025-01-01T00:00:00+00:00\"'"),
    ]
) + " || '}'"

# Hits of a receipt: field, label, raw value, line; in field and label order.
RECEIPT_HITS = [
    ("tax", "sales tax", "'$3.00'", 10), ("tax", "tax", "'$1.' || (c_custkey % 90 + 10)", 7),
    ("tax", "gst", "'$' || (c_custkey % 9 + 1) || '.25'", 9),
    ("company_name", "company name", "'Shop ' || c_custkey % 7", 1),
    ("cashier_name", "served by", "'Clerk ' || c_custkey % 5", 2), ("cashier_name", "cashier", "'Clerk ' || c_custkey % 5", 3),
    ("phone", "phone", "'none'", 11), ("quarter", "quarter", "'Q' || (c_custkey % 4 + 1) || ' 2001'", 4),
    ("total_revenue", "gross revenue", "'$' || c_custkey || '.50'", 5),
]
RECEIPTS = "hits AS (" + " UNION ALL ".join(
    f"SELECT 'receipt-' || c_custkey AS doc_id, {i} AS match_no, {s(f)} AS field, {s(label)} AS matched_label, {raw} AS raw_value, "
    + (f"NULL::VARCHAR AS text_value, replace({raw}, '$', '')::DOUBLE AS number_value, "
       if f in MONEY_FIELDS else f"{raw} AS text_value, NULL::DOUBLE AS number_value, ")
    + f"{line} AS line_no FROM customer"
    for i, (f, label, raw, line) in enumerate(RECEIPT_HITS)) + ")"

ORACLES = {
    "token_rows": with_(DOCS, WORDS)
    + f"SELECT doc_id, unnest(range(2 * len(w) - 1)) AS pos, unnest(list_concat(w, {PAIRS})) AS token FROM words",
    "term_counts": with_(DOCS, COUNTS) + "SELECT * FROM counts",
    "bigrams": with_(DOCS, WORDS) + f"SELECT doc_id, unnest(range(len(w) - 1)) AS pos, unnest({PAIRS}) AS bigram FROM words",
    "doc_frequency": with_(DOCS, COUNTS, DF) + "SELECT * FROM df",
    "idf": with_(DOCS, COUNTS, DF)
    + "SELECT token, df, round(ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1, 9) AS idf FROM df",
    "tfidf": with_(DOCS, COUNTS, PROTO) + """
SELECT doc_id, token, cnt,
  round(cnt::DOUBLE / sum(cnt) OVER (PARTITION BY doc_id) * coalesce(idf, 1.0::DOUBLE), 10) AS weight
FROM counts LEFT JOIN rule_idf USING (token)""",
    "corpus_tfidf": with_(DOCS, COUNTS, DF) + """
SELECT doc_id, token, cnt, round(cnt::DOUBLE / sum(cnt) OVER (PARTITION BY doc_id)
  * (ln((1 + (SELECT count(*) FROM documents))::DOUBLE / (1 + df)) + 1), 9) AS weight
FROM counts JOIN df USING (token)""",
    "cosine": with_(DOCS, COSINE) + "SELECT doc_id, category, round(similarity, 8) AS similarity FROM cosines",
    "alias_scores": with_(PLAIN_AND_BUSINESS, RULES) + "SELECT doc_id, "
    + ", ".join(f"a_{x} AS alias_{x}" for x in SHORT.values()) + " FROM rule_scores",
    "structural_scores": with_(PLAIN_AND_BUSINESS, RULES) + "SELECT doc_id, "
    + ", ".join(f"l_{x} AS structural_{x}" for x in SHORT.values()) + " FROM rule_scores",
    "combined_scores": with_(DOCS, COMBINED) + "SELECT doc_id, "
    + ", ".join(f"round(c_{x}, 8) AS score_{x}" for x in SHORT.values()) + " FROM combined",
    "classify": with_(DOCS, COMBINED) + CLASSIFIED,
    "category_counts": with_(DOCS, COMBINED) + "SELECT category, count(*) AS documents FROM classified GROUP BY 1",
    "business_scores": with_(BUSINESS_SRC, COMBINED) + CLASSIFIED,
    "business_categories": with_(BUSINESS_SRC, COMBINED)
    + "SELECT category, count(*) AS documents FROM classified GROUP BY 1",
    "lines": r"""
WITH marked AS (
  SELECT doc_id, string_split(regexp_replace(text, '\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]', chr(10), 'g'), chr(10)) AS p
  FROM documents),
trimmed AS (SELECT doc_id, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS p FROM marked),
numbered AS (SELECT doc_id, unnest(p) AS line, unnest(range(len(p))) AS line_no FROM trimmed)
SELECT doc_id, line_no, line, lead(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS next_line FROM numbered""",
    "sentences": with_(DOCS, SENTENCES) + "SELECT doc_id, sent_no, sentence FROM sents",
    "sentence_scores": with_(DOCS, SENTENCES) + "SELECT doc_id, sent_no, score, words FROM scores",
    "summary_tokens": with_(DOCS, SENTENCES) + "SELECT doc_id, sent_no, token FROM good",
    "summarize": with_(DOCS, SUMMARY)
    + "SELECT src.doc_id, coalesce(summary, '') AS summary FROM src LEFT JOIN summaries USING (doc_id)",
    "emails": f"SELECT doc_id, {PLAIN_EMAIL} AS email FROM documents",
    "phones": r"""SELECT doc_id, nullif(regexp_extract(text, '\+?\d[\d\-\s\(\)]{7,}\d'), '') AS phone FROM documents""",
    "currency_flag": f"SELECT doc_id, {PLAIN_CURRENCY} AS currency FROM documents",
    "largest_amounts": with_(PLAIN_AND_BUSINESS) + f"SELECT doc_id, list_max({AMOUNTS}) AS largest_amount FROM src",
    "invoice_totals": """
SELECT l_orderkey AS order_key, count(*) AS lines, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS subtotal,
  round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 0.17::DECIMAL(3,2), 2)::DOUBLE AS tax,
  (sum(CAST(l_extendedprice AS DECIMAL(18,2)))
    + round(sum(CAST(l_extendedprice AS DECIMAL(18,2))) * 0.17::DECIMAL(3,2), 2))::DOUBLE AS total
FROM lineitem GROUP BY 1""",
    "revenue_breakdown": with_(REVENUE) + """
SELECT region, quarter, coalesce(product_line, 'TOTAL') AS product_line, units, revenue::DOUBLE AS revenue,
  round(revenue::DOUBLE / (sum(revenue) FILTER (product_line IS NOT NULL) OVER (PARTITION BY region, quarter))::DOUBLE * 100, 1) AS percent
FROM (
  SELECT region, quarter, product_line, sum(units) AS units, sum(revenue) AS revenue
  FROM revenue GROUP BY GROUPING SETS ((region, quarter, product_line), (region, quarter)))""",
    "business_documents": with_(BUSINESS)
    + "SELECT doc_id, 'business-inbox' AS source_bucket, source_key, text FROM business",
    "invoice_metadata": with_(ORDER_SUMS) + fields_select("'invoice-' || k", INVOICE_FIELDS, "order_head"),
    "sales_report_metadata": with_(REPORTS) + fields_select("'report-' || slug", REPORT_FIELDS, "report_heads"),
    "application_metadata": with_(APPLICANTS) + fields_select("'application-' || n", APPLICATION_FIELDS, "applicants"),
    "metadata": with_(
        BUSINESS, META,
        "src AS (SELECT doc_id, text FROM business UNION ALL SELECT doc_id::VARCHAR, text FROM documents)",
        COMBINED,
    ) + f"""
SELECT doc_id, category, coalesce(metadata, CASE category
  {" ".join(f"WHEN {s(c)} THEN {plain_json(c)}" for c in CATEGORIES)} ELSE {WARNING} END) AS metadata
FROM classified JOIN src USING (doc_id) LEFT JOIN meta USING (doc_id)""",
    "keyword_matches": with_(EVIDENCE) + "SELECT * FROM evidence",
    "keyword_fields": with_(EVIDENCE) + f"SELECT doc_id, field, 1 AS hits, {VALUE} AS value FROM evidence",
    "events_unnest": with_(EVENTS) + "SELECT * FROM flagged",
    "pdf_uploads": with_(EVENTS) + "SELECT DISTINCT source_bucket, source_key FROM flagged WHERE accepted",
    "assemble_pages": f"""
SELECT 'chats' AS source_bucket, {CHAT} AS source_key, trim(string_agg(text, chr(10) ORDER BY turn), E' \\t\\n\\r') AS text,
  count(*) AS num_pages, len(trim(string_agg(text, chr(10) ORDER BY turn), E' \\t\\n\\r')) AS char_count
FROM conversations GROUP BY conv_id""",
    "quarantine_empty": with_(ORDERED)
    + "SELECT source_bucket, source_key, num_pages, error FROM order_outcomes WHERE error = 'no extractable text'",
    "missing_inputs": with_(ORDERED)
    + "SELECT source_bucket, source_key FROM order_outcomes WHERE error = 'missing input'",
    "two_buckets": f"""
WITH chats AS (
  SELECT {CHAT} AS source_key, trim(string_agg(text, chr(10) ORDER BY turn), E' \\t\\n\\r') AS text, count(*) AS num_pages
  FROM conversations GROUP BY conv_id)
SELECT 'chats' AS source_bucket, source_key, text, num_pages, len(text) AS char_count, NULL::VARCHAR AS error FROM chats
UNION ALL SELECT 'copies', source_key, replace(text, 'e', '3'), num_pages, len(text), NULL FROM chats
UNION ALL SELECT 'lost', source_key, NULL, NULL, NULL, 'missing input' FROM chats""",
    "events_rejected": "SELECT DISTINCT html AS body, 'unreadable notification' AS error FROM pages",
    "receipt_matches": with_(RECEIPTS) + "SELECT * FROM hits",
    "receipt_fields": with_(RECEIPTS) + f"""
SELECT doc_id, field, count(*) AS hits, CASE WHEN count(*) = 1 THEN any_value({VALUE})
  ELSE '[' || string_agg({VALUE}, ', ' ORDER BY match_no) || ']' END AS value FROM hits GROUP BY doc_id, field""",
    "plain_summaries": """
SELECT doc_id, coalesce((SELECT string_agg('It was of the ' || doc_id || ' and ' || i || '.', ' ' ORDER BY i)
  FROM range(1, least(doc_id % 7, 3) + 1) AS t(i)), '') AS summary FROM documents""",
    "untotalled_reports": with_(REVENUE) + """
SELECT 'report-' || lower(replace(region || '-' || quarter, ' ', '-')) AS doc_id, max(revenue)::DOUBLE AS total_revenue, 'USD' AS currency
FROM revenue GROUP BY region, quarter""",
    "sink_records": with_(RECORDS) + """
SELECT * EXCLUDE (source_path), true AS in_json, true AS timed FROM recs
WHERE source_key LIKE 'applications/%' AND regexp_extract(source_key, '[0-9]+')::BIGINT % 10 = 7""",
    "page_versions": f"""
WITH versions AS (
  SELECT conv_id, turn, 0 AS arrival, text FROM conversations
  UNION ALL SELECT conv_id, turn, 1, text FROM conversations WHERE turn % 4 = 1
  UNION ALL SELECT conv_id, turn, 1, replace(text, 'e', '3') FROM conversations WHERE turn % 3 = 0
  UNION ALL SELECT conv_id, turn, 2, text || ' (last)' FROM conversations WHERE turn % 6 = 0),
numbered AS (SELECT conv_id, turn, max(struct_pack(a := arrival, t := text)).t AS text FROM versions GROUP BY conv_id, turn),
listed AS (
  SELECT conv_id, 0 AS kind, turn, text FROM numbered
  UNION ALL SELECT conv_id, 1, turn, 'note ' || (turn % 2) FROM conversations, range(2) WHERE turn % 5 = 1),
joined AS (
  SELECT conv_id, trim(string_agg(text, chr(10) ORDER BY kind, turn, text), E' \\t\\n\\r') AS text, count(*) AS num_pages
  FROM listed GROUP BY conv_id)
SELECT {CHAT} AS source_key, text, num_pages, len(text) AS char_count FROM joined""",
    "latest_pages": f"""
SELECT {CHAT} AS source_key, turn::INTEGER AS page_no, n::INTEGER AS arrival, text || CASE n WHEN 0 THEN '' ELSE ' v' || n END AS page_text
FROM (SELECT *, CASE WHEN turn % 4 = 0 THEN 3 WHEN turn % 3 = 0 THEN 2 WHEN turn % 2 = 0 THEN 1 ELSE 0 END AS n FROM conversations)""",
    "upload_summary": with_(EVENTS, """
named AS (SELECT DISTINCT source_bucket, source_key FROM flagged WHERE accepted),
counts AS (
  SELECT (SELECT count(*) FROM named) AS named, (SELECT count(*) FROM named WHERE source_key LIKE 'My %') AS processed,
    (SELECT count(DISTINCT path) FROM parts) AS nameless)""") + """
SELECT named + nameless AS received, processed, named - processed + nameless AS failed,
  CASE WHEN named - processed + nameless = 0 THEN 200 ELSE 207 END AS status_code FROM counts""",
    "stream_records": f"""
SELECT 'chats' AS source_bucket, {CHAT} AS source_key, count(*) AS num_pages,
  len(trim(string_agg(text, chr(10) ORDER BY turn), E' \\t\\n\\r')) AS char_count, NULL::VARCHAR AS error
FROM conversations GROUP BY conv_id""",
    "paged_cosine": with_(DOCS, COSINE) + "SELECT doc_id, category, round(similarity, 8) AS similarity FROM cosines",
    "paged_sentence_scores": with_(DOCS, SENTENCES) + "SELECT doc_id, sent_no, score, words FROM scores",
    "stream_totals": with_(f"""
chats AS (
  SELECT conv_id, trim(string_agg(text, chr(10) ORDER BY turn), E' \\t\\n\\r') AS text FROM conversations GROUP BY conv_id),
src AS (SELECT conv_id AS doc_id, text FROM chats WHERE conv_id % 5 <> 0)""", COMBINED) + """
SELECT category, NULL::VARCHAR AS error, count(*) AS documents FROM classified GROUP BY category
UNION ALL SELECT NULL, 'missing input', count(*) FROM chats WHERE conv_id % 5 = 0""",
    "manifest_changes": """
SELECT 'web' AS source_bucket, 'p/' || page_id || '.pdf' AS source_key, CASE WHEN page_id % 5 = 0 THEN 'gone' ELSE 'changed' END AS change
FROM pages WHERE page_id % 5 IN (0, 1, 2)
UNION ALL SELECT 'web', 'new/p/' || page_id || '.pdf', 'added' FROM pages WHERE page_id % 7 = 3""",
    "paged_summaries": with_(DOCS, SUMMARY)
    + "SELECT src.doc_id, coalesce(summary, '') AS summary FROM src LEFT JOIN summaries USING (doc_id)",
    "paged_keyword_matches": with_(EVIDENCE) + "SELECT * FROM evidence",
    "signed_labels": with_(BUSINESS, """
hits AS (
  SELECT 'invoice-' || k AS doc_id, unnest([
    struct_pack(match_no := 0, field := 'invoice_number', matched_label := 'invoice-no (ours)', raw_value := 'INV-' || y || '-' || k, line_no := 1),
    struct_pack(match_no := 1, field := 'invoice_number', matched_label := 'invoice-no', raw_value := 'INV-' || y || '-' || k, line_no := 1),
    struct_pack(match_no := 2, field := 'customer_name', matched_label := 'bill-to', raw_value := replace(c_name, '#', ' '), line_no := 4)]) AS h
  FROM order_head
  UNION ALL SELECT 'application-' || n, unnest([
    struct_pack(match_no := 0, field := 'email', matched_label := 'e-mail', raw_value := 'applicant' || n || '@example.org', line_no := 8),
    struct_pack(match_no := 1, field := 'employer', matched_label := 'employer: since 2001', raw_value := 'Works ' || c_nationkey || ' Limited', line_no := 12),
    struct_pack(match_no := 2, field := 'employer', matched_label := 'employer', raw_value := 'since 2001 - Works ' || c_nationkey || ' Limited', line_no := 12)])
  FROM applicants)""") + "SELECT doc_id, unnest(h), h.raw_value AS text_value FROM hits",
    "records": with_(RECORDS) + "SELECT * FROM recs",
    "records_csv": with_(RECORDS) + f"""
SELECT document_id, filename, source_bucket, source_key, '' AS source_path, s3_uri, category, best_category_match,
  {CONFIDENCE_TEXT} AS confidence, num_pages::VARCHAR AS num_pages, char_count::VARCHAR AS char_count, extractor, summary,
  metadata, keyword_fields, keyword_matches, category_scores, category_alias_scores, category_tfidf_scores,
  category_structural_scores FROM recs""",
    "records_json": with_(RECORDS) + f"SELECT document_id, source_key, {JSON_RECORD} AS value FROM recs",
    "processed_list": with_(RECORDS) + "SELECT document_id, filename, category FROM recs",
    "audit_view": with_(RECORDS) + """
SELECT document_id, filename, category, confidence, array_to_string(json_keys(metadata), ',') AS metadata_keys,
  array_to_string(json_keys(keyword_fields), ',') AS keyword_field_keys, len(summary) AS summary_chars FROM recs""",
    "run_summary": with_(ORDERED) + """
SELECT count(*) AS received, count(*) FILTER (error IS NULL) AS processed, count(*) FILTER (error IS NOT NULL) AS failed,
  CASE WHEN count(*) FILTER (error IS NOT NULL) = 0 THEN 200 ELSE 207 END AS status_code FROM order_outcomes""",
    "rejects": with_(ORDERED) + """
SELECT split_part(source_key, '/', -1) AS filename, 's3://business-inbox/' || source_key AS s3_uri, num_pages, error
FROM order_outcomes WHERE error IS NOT NULL""",
    "output_parity_files": with_(ORDERED) + """
SELECT source_bucket, source_key, true AS in_inputs, false AS in_csv, false AS in_json
FROM order_outcomes WHERE error IS NOT NULL AND regexp_extract(source_key, '[0-9]+')::BIGINT % 20 = 3""",
    "output_parity": with_(ORDERED) + """
SELECT source_bucket, source_key, true AS in_inputs, false AS in_csv, false AS in_json
FROM order_outcomes WHERE error IS NOT NULL""",
}
