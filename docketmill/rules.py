"""Rule tables: everything a user may change without touching an operator.

A :class:`RuleSet` is a small immutable bundle of constants that is compiled
into literal Spark expressions.  It never grows with the data, which is why
operators may embed it (or broadcast a table made from it) without a size check.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import cached_property

# --------------------------------------------------------------------------
# Category prototypes, phrase rules, layout rules.
# --------------------------------------------------------------------------
PROTOTYPES = {
    "Invoice": (
        "invoice number invoice id bill to billed to customer client invoice date "
        "due date payment terms subtotal sub total net amount tax sales tax vat gst "
        "tariff tarif levy duty total amount due balance due amount payable grand "
        "total unit price quantity line item remit payment billing"
    ),
    "Sales Report": (
        "sales report quarterly monthly annual revenue reporting period region "
        "territory market executive summary product line units sold revenue "
        "breakdown year over year growth performance forecast observations "
        "recommendations total revenue gross revenue"
    ),
    "Customer Application": (
        "customer application form account application applicant full name personal "
        "information date of birth dob national id social security email phone "
        "residential address employer job title annual income account type "
        "signature certify true complete authorize credit check"
    ),
}

PHRASE_RULES = {
    "Invoice": [
        (r"\binvoice\s*(number|no\.?|#|id)?\b", 3.0),
        (r"\bINV[-\s]?\d{2,}\b", 3.0),
        (r"\btotal\s+amount\s+due\b", 2.5),
        (r"\b(amount|balance|total)\s+(due|payable)\b", 2.5),
        (r"\b(grand\s+total|total\s+payable)\b", 2.0),
        (r"\b(bill|billed)\s+to\b", 2.0),
        (r"\bpayment\s+terms\b", 1.5),
        (r"\b(subtotal|sub\s+total|net\s+amount)\b", 1.5),
        (r"\b(tax|sales\s+tax|vat|gst|tariff|tarif|levy|duty)\b", 1.0),
        (r"\bdue\s+date\b", 1.5),
    ],
    "Sales Report": [
        (r"\bsales\s+report\b", 3.0),
        (r"\b(quarterly|monthly|annual)\b", 2.0),
        (r"\bQ[1-4]\s*20\d{2}\b", 2.5),
        (r"\bexecutive\s+summary\b", 2.0),
        (r"\b(revenue|sales)\s+breakdown\b", 2.5),
        (r"\b(total\s+revenue|gross\s+revenue|units\s+sold)\b", 2.0),
        (r"\b(region|territory|market)\b", 1.2),
        (r"\byear[-\s]over[-\s]year\b", 1.5),
        (r"\b(forecast|recommendations|growth|performance)\b", 1.0),
    ],
    "Customer Application": [
        (r"\b(customer|client|account)\s+application\b", 3.0),
        (r"\bapplication\s+(form|id)\b", 2.5),
        (r"\bAPP[-\s]?\d{2,}\b", 2.5),
        (r"\bdate\s+of\s+birth\b", 2.0),
        (r"\bDOB\b", 2.0),
        (r"\b(full\s+name|applicant\s+name)\b", 1.8),
        (r"\bnational\s+id\b|\bssn\b|\bsocial\s+security\b", 2.0),
        (r"\bemployer\b", 1.5),
        (r"\bannual\s+income\b", 1.5),
        (r"\baccount\s+type\b", 1.5),
        (r"\bsignature\b|\bcertify\b|\bauthorize\b", 1.0),
    ],
}

LAYOUT_RULES = {
    "Invoice": [
        (r"(?is)\bdescription\b.+\bqty\b.+\bunit\s+price\b.+\btotal\b", 3.0),
        (r"(?is)\bsubtotal\b.+\b(total\s+amount\s+due|amount\s+due|grand\s+total)\b", 2.5),
        (r"(?im)^\s*(tax|sales\s+tax|vat|gst|tariff|tarif|levy|duty)(?:\s*\([^)]*\))?\s*[:\-]", 1.8),
        (r"(?im)^\s*(bill\s+to|billed\s+to)\s*[:\-]?\s*$", 1.8),
    ],
    "Sales Report": [
        (r"(?is)\b(region|product\s+line)\b.+\b(revenue|units\s+sold|growth)\b", 3.0),
        (r"(?is)\bexecutive\s+summary\b.+\b(recommendations?|forecast)\b", 2.0),
        (r"(?im)^\s*(reporting\s+period|region|report\s+generated)\s*[:\-]", 1.8),
        (r"\b\d+(?:\.\d+)?\s*%\b", 1.0),
    ],
    "Customer Application": [
        (r"(?is)\bpersonal\s+information\b.+\bemployment\s+information\b", 3.0),
        (r"(?is)\bfull\s+name\b.+\bdate\s+of\s+birth\b.+\bemail\s+address\b", 2.5),
        (r"(?is)\bemployer\b.+\bjob\s+title\b.+\bannual\s+income\b", 2.0),
        (r"(?is)\bsignature\b.+\bcertify\b", 1.5),
    ],
}

# Literals a phrase or layout pattern cannot match without: at least one of them
# occurs, whatever its case, in every match.  They let most texts skip most
# patterns; a pattern without an entry is always tried.
CUES = {
    r"\binvoice\s*(number|no\.?|#|id)?\b": ("invoice",),
    r"\bINV[-\s]?\d{2,}\b": ("inv",),
    r"\btotal\s+amount\s+due\b": ("amount",),
    r"\b(amount|balance|total)\s+(due|payable)\b": ("due", "payable"),
    r"\b(grand\s+total|total\s+payable)\b": ("total",),
    r"\b(bill|billed)\s+to\b": ("bill",),
    r"\bpayment\s+terms\b": ("payment",),
    r"\b(subtotal|sub\s+total|net\s+amount)\b": ("total", "amount"),
    r"\b(tax|sales\s+tax|vat|gst|tariff|tarif|levy|duty)\b": ("tax", "vat", "gst", "tarif", "levy", "duty"),
    r"\bdue\s+date\b": ("due",),
    r"\bsales\s+report\b": ("report",),
    r"\b(quarterly|monthly|annual)\b": ("quarterly", "monthly", "annual"),
    r"\bQ[1-4]\s*20\d{2}\b": ("q1", "q2", "q3", "q4"),
    r"\bexecutive\s+summary\b": ("executive",),
    r"\b(revenue|sales)\s+breakdown\b": ("breakdown",),
    r"\b(total\s+revenue|gross\s+revenue|units\s+sold)\b": ("revenue", "units"),
    r"\b(region|territory|market)\b": ("region", "territory", "market"),
    r"\byear[-\s]over[-\s]year\b": ("year",),
    r"\b(forecast|recommendations|growth|performance)\b": ("forecast", "recommendations", "growth", "performance"),
    r"\b(customer|client|account)\s+application\b": ("application",),
    r"\bapplication\s+(form|id)\b": ("application",),
    r"\bAPP[-\s]?\d{2,}\b": ("app",),
    r"\bdate\s+of\s+birth\b": ("birth",),
    r"\bDOB\b": ("dob",),
    r"\b(full\s+name|applicant\s+name)\b": ("name",),
    r"\bnational\s+id\b|\bssn\b|\bsocial\s+security\b": ("national", "ssn", "social"),
    r"\bemployer\b": ("employer",),
    r"\bannual\s+income\b": ("income",),
    r"\baccount\s+type\b": ("account",),
    r"\bsignature\b|\bcertify\b|\bauthorize\b": ("signature", "certify", "authorize"),
    r"(?is)\bdescription\b.+\bqty\b.+\bunit\s+price\b.+\btotal\b": ("qty",),
    r"(?is)\bsubtotal\b.+\b(total\s+amount\s+due|amount\s+due|grand\s+total)\b": ("subtotal",),
    r"(?im)^\s*(tax|sales\s+tax|vat|gst|tariff|tarif|levy|duty)(?:\s*\([^)]*\))?\s*[:\-]": ("tax", "vat", "gst", "tarif", "levy", "duty"),
    r"(?im)^\s*(bill\s+to|billed\s+to)\s*[:\-]?\s*$": ("bill",),
    r"(?is)\b(region|product\s+line)\b.+\b(revenue|units\s+sold|growth)\b": ("revenue", "units", "growth"),
    r"(?is)\bexecutive\s+summary\b.+\b(recommendations?|forecast)\b": ("executive",),
    r"(?im)^\s*(reporting\s+period|region|report\s+generated)\s*[:\-]": ("period", "region", "generated"),
    r"\b\d+(?:\.\d+)?\s*%\b": ("%",),
    r"(?is)\bpersonal\s+information\b.+\bemployment\s+information\b": ("employment",),
    r"(?is)\bfull\s+name\b.+\bdate\s+of\s+birth\b.+\bemail\s+address\b": ("birth",),
    r"(?is)\bemployer\b.+\bjob\s+title\b.+\bannual\s+income\b": ("employer",),
    r"(?is)\bsignature\b.+\bcertify\b": ("certify",),
}

# --------------------------------------------------------------------------
# Score weights and acceptance thresholds.
# --------------------------------------------------------------------------
PHRASE_WEIGHT = 0.40
TFIDF_WEIGHT = 0.35
LAYOUT_WEIGHT = 0.25
MIN_TOP_SCORE = 0.35
MIN_MARGIN = 0.12

# --------------------------------------------------------------------------
# Canonical label/value fields and the labels that name them.
# --------------------------------------------------------------------------
FIELD_ALIASES = {
    "invoice_number": [
        "invoice number",
        "invoice no",
        "invoice #",
        "invoice id",
        "inv no",
        "inv #",
    ],
    "invoice_date": ["invoice date", "bill date", "date issued"],
    "due_date": ["due date", "payment due date", "pay by"],
    "subtotal": ["subtotal", "sub total", "net amount"],
    "tax": ["tax", "sales tax", "vat", "gst", "tariff", "tarif", "levy", "duty"],
    "total_amount_due": [
        "total amount due",
        "amount due",
        "balance due",
        "amount payable",
        "total payable",
        "grand total",
        "total due",
    ],
    "customer_name": ["customer name", "client name", "bill to", "billed to"],
    "company_name": ["company name", "organization", "business name", "vendor"],
    "cashier_name": ["cashier", "cashier name", "served by", "prepared by"],
    "email": ["email", "email address", "contact email"],
    "phone": ["phone", "phone number", "contact number", "mobile"],
    "address": ["address", "billing address", "residential address"],
    "application_id": ["application id", "app id", "application number"],
    "applicant_name": ["applicant name", "full name", "name"],
    "date_of_birth": ["date of birth", "dob"],
    "account_type": ["account type", "account type requested"],
    "employer": ["employer", "company employer"],
    "annual_income": ["annual income", "income", "yearly income"],
    "reporting_period": ["reporting period", "period"],
    "quarter": ["quarter", "reporting quarter"],
    "region": ["region", "sales region"],
    "total_revenue": ["total revenue", "revenue total", "gross revenue"],
}

MONEY_FIELDS = frozenset(
    {"subtotal", "tax", "total_amount_due", "annual_income", "total_revenue"}
)

# --------------------------------------------------------------------------
# Value patterns.
# --------------------------------------------------------------------------
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?\d[\d\-\s\(\)]{7,}\d"
VALUE_MONEY = r"\$?\s*[\d,]+(?:\.\d{2})?"
DOLLAR_AMOUNT = r"\$\s?[\d,]+(?:\.\d{2})?"

# --------------------------------------------------------------------------
# Category-specific fields as (field, kind, pattern), in output
# order.  A pattern is searched case-insensitively and its first group is kept.
# Kinds: text = the group; text_or_null = an empty group counts as missing;
# first_line = cut at the first newline; money = a number; largest_money = a
# number, else the largest dollar amount; email / dollar_sign = no label needed.
# --------------------------------------------------------------------------
CATEGORY_FIELDS = {
    "Invoice": [
        ("invoice_number", "text", r"Invoice\s*(?:Number|No\.?|#)\s*[:\-]?\s*([A-Z0-9\-]+)"),
        ("invoice_date", "first_line", r"Invoice\s*Date\s*[:\-]?\s*([0-9A-Za-z\-/\s]+)"),
        ("due_date", "first_line", r"Due\s*Date\s*[:\-]?\s*([0-9A-Za-z\-/\s]+)"),
        ("bill_to", "text", r"Bill\s*To:\s*\n?\s*([A-Za-z0-9&\.,\- ]+?)\s*\n"),
        ("customer_email", "email", None),
        ("subtotal", "money", r"Subtotal[:\s]*\$?\s*([\d,]+\.\d{2})"),
        ("tax", "money", r"Tax\s*\([^)]*\)[:\s]*\$?\s*([\d,]+\.\d{2})"),
        ("total_amount_due", "money", r"Total\s+Amount\s+Due[:\s]*\$?\s*([\d,]+\.\d{2})"),
        ("currency", "dollar_sign", None),
    ],
    "Sales Report": [
        ("reporting_period", "text", r"Reporting\s*Period\s*[:\-]?\s*([^\n]+)"),
        ("quarter", "text", r"\b(Q[1-4]\s*20\d{2})\b"),
        ("region", "text", r"Region\s*[:\-]?\s*([^\n]+)"),
        ("report_generated", "text", r"Report\s*Generated\s*[:\-]?\s*([0-9\-/]+)"),
        ("total_revenue", "largest_money", r"TOTAL\s+\$?\s*([\d,]+\.\d{2})\s*100"),
        ("currency", "dollar_sign", None),
    ],
    "Customer Application": [
        ("application_id", "text", r"Application\s*ID\s*[:\-]?\s*([A-Z0-9\-]+)"),
        ("application_date", "text", r"Date\s*of\s*Application\s*[:\-]?\s*([0-9\-/]+)"),
        ("account_type", "text_or_null", r"Account\s*Type(?:\s*Requested)?\s*[:\-]?\s*([^\n]+)"),
        ("applicant_name", "text", r"Full\s*Name:\s*([A-Za-z][A-Za-z\.\-' ]+?)\s*\n"),
        ("date_of_birth", "text", r"Date\s*of\s*Birth:\s*([0-9\-/]+)"),
        ("national_id", "text", r"(?:National\s*ID|SSN|Social\s*Security)[^:]*:\s*([A-Z0-9\-]+)"),
        ("email", "email", None),
        ("phone", "text_or_null", r"Phone\s*Number:\s*(\+?[\d\-\s\(\)]+)"),
        ("employer", "text_or_null", r"Employer:\s*([^\n]+)"),
        ("job_title", "text_or_null", r"Job\s*Title:\s*([^\n]+)"),
        ("annual_income", "text_or_null", r"Annual\s*Income:\s*([^\n]+)"),
    ],
}

# --------------------------------------------------------------------------
# Words ignored when sentences are scored.
# --------------------------------------------------------------------------
STOPWORDS = frozenset("""
a an the and or but if then else for of on in at by to from with without
is are was were be been being am have has had do does did this that these
those it its as not no than too very can will would should could may might
must shall i you he she we they them us our your their my mine yours his
hers ours theirs which who whom whose what when where why how about above
after again against all also any because before below between both during
each few further here into more most other own same so some such only over
under up down out off again own same so much
""".split())

UNKNOWN = "Unknown"


def column_name(category: str) -> str:
    """`Sales Report` -> `sales_report`: how a category appears in column names."""
    return re.sub(r"\W+", "_", category.strip().lower())


@dataclass(frozen=True)
class RuleSet:
    """All constants of one tagging setup; categories are listed in tie order."""

    prototypes: dict = field(default_factory=lambda: PROTOTYPES)
    phrase_rules: dict = field(default_factory=lambda: PHRASE_RULES)
    layout_rules: dict = field(default_factory=lambda: LAYOUT_RULES)
    cues: dict = field(default_factory=lambda: CUES)
    category_fields: dict = field(default_factory=lambda: CATEGORY_FIELDS)
    field_aliases: dict = field(default_factory=lambda: FIELD_ALIASES)
    money_fields: frozenset = MONEY_FIELDS
    stopwords: frozenset = STOPWORDS
    phrase_weight: float = PHRASE_WEIGHT
    tfidf_weight: float = TFIDF_WEIGHT
    layout_weight: float = LAYOUT_WEIGHT
    min_top_score: float = MIN_TOP_SCORE
    min_margin: float = MIN_MARGIN

    @property
    def categories(self) -> list[str]:
        return list(self.prototypes)

    @cached_property
    def prototype_counts(self) -> dict[str, Counter]:
        """Word and bigram counts of each prototype text."""
        out = {}
        for category, text in self.prototypes.items():
            w = re.findall("[a-z][a-z0-9]+", text.lower())
            out[category] = Counter(w + [" ".join(p) for p in zip(w, w[1:])])
        return out

    @cached_property
    def idf(self) -> dict[str, float]:
        """Smoothed inverse document frequency over the prototypes."""
        n = len(self.prototypes)
        df = Counter(t for counts in self.prototype_counts.values() for t in counts)
        return {t: math.log((1 + n) / (1 + k)) + 1 for t, k in sorted(df.items())}

    @cached_property
    def unit_vectors(self) -> dict[str, dict[str, float]]:
        """TF-IDF vector of each prototype, scaled to length one."""
        out = {}
        for category, counts in self.prototype_counts.items():
            w = {t: k * self.idf[t] for t, k in counts.items()}
            norm = math.sqrt(math.fsum(x * x for x in w.values())) or 1.0
            out[category] = {t: x / norm for t, x in w.items()}
        return out

    def field_kind(self, name: str) -> str:
        if name in self.money_fields:
            return "money"
        return name if name in ("email", "phone") else "text"

    @cached_property
    def alias_rows(self) -> list[tuple[str, int, str, int, str]]:
        """(field, field_ord, alias, alias_ord, kind); longer aliases come first."""
        rows = []
        for f_ord, (name, aliases) in enumerate(self.field_aliases.items()):
            by_length = sorted(aliases, key=lambda a: -len(a))
            rows += [
                (name, f_ord, alias, a_ord, self.field_kind(name))
                for a_ord, alias in enumerate(by_length)
            ]
        labels = [r[2] for r in rows]
        odd = [a for a in labels if not a or re.search(r"\s\s|^\s|\s$", a) or a != a.lower()]
        if odd or len(set(labels)) != len(labels):
            raise ValueError(f"aliases must be distinct, lower case and single spaced: {odd or 'duplicates'}")
        return rows


DEFAULT_RULES = RuleSet()
