"""Business documents written from the order tables: text with known answers.

Every document is a fixed set of lines filled from one row of aggregates, so
nothing is collected per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketmill.operators import billing as B
from docketmill.operators.rows import spread

BUCKET = "business-inbox"
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
MONTHS = {1: "January - March", 4: "April - June", 7: "July - September", 10: "October - December"}


def _text(value: Column) -> Column:
    return value.cast("string")


def _money(value: Column) -> Column:
    return F.concat(F.lit("$"), _text(value.cast(B.MONEY)))


def _grouped_money(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value.cast(B.MONEY), 2))


def _page(*parts) -> Column:
    """Lines joined by newlines; a NULL line is left out."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _after(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value)


def _item(name: str, qty: str, amount: str) -> Column:
    units = F.col(qty).cast("bigint")
    cents = (F.col(amount) * 100).cast("bigint")
    unit_cents = F.floor(cents / units).cast("bigint")
    unit = F.format_string("%d.%02d", F.floor(unit_cents / 100).cast("bigint"), unit_cents % 100)
    line = F.concat(F.lit(f"{name} "), _text(units), F.lit(" $"), unit, F.lit(" "), _money(F.col(amount)))
    return F.when(units > 0, line)


def invoices(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """`(doc_id, source_bucket, source_key, text)`: one invoice per order with lines."""
    rows = B.order_totals(lineitem).join(
        orders.select(F.col("o_orderkey").alias("order_key"), "o_custkey",
                      F.col("o_orderdate").cast("date").alias("day")), "order_key"
    ).join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_name"), "o_custkey")
    rows = spread(rows, "order_key", "o_custkey", "day")
    tax = B.tax_of(F.col("subtotal"))
    key, day = _text(F.col("order_key")), _text(F.col("day"))
    text = _page(
        "INVOICE",
        F.concat(F.lit("Invoice Number: INV-"), _text(F.year("day")), F.lit("-"), key),
        _after("Invoice Date: ", day),
        _after("Due Date: ", day),
        "Bill To:",
        F.translate("c_name", "#", " "),
        F.concat(_text(F.col("o_custkey") % 90 + 10), F.lit(" Harbor Road")),
        F.concat(F.lit("Email: billing"), _text(F.col("o_custkey")), F.lit("@example.com")),
        "Description Qty Unit Price Total",
        _item("Accepted items", "qty_a", "amount_a"),
        _item("New items", "qty_n", "amount_n"),
        _item("Returned items", "qty_r", "amount_r"),
        _item("Other items", "qty_o", "amount_o"),
        _after("Subtotal: ", _money(F.col("subtotal"))),
        _after("Tax (17%): ", _money(tax)),
        _after("Total Amount Due: ", _money(F.col("subtotal") + tax)),
        "Payment Terms: Net 30 days. Please pay by the date above. Late payments carry a fee.",
    )
    return rows.select(
        _after("invoice-", key).alias("doc_id"),
        F.lit(BUCKET).alias("source_bucket"),
        F.concat(F.lit("invoices/"), key, F.lit(".pdf")).alias("source_key"),
        text.alias("text"),
    )


def sales_reports(revenue: DataFrame) -> DataFrame:
    """One report per region and quarter, from `billing.segment_revenue`.

    The listed product lines are a fixed domain; any other one is summed as
    `OTHER`, so a report is one row of conditional sums.
    """
    line = F.col("product_line")
    aggs = [F.sum("units").alias("units"), F.sum("revenue").cast(B.MONEY).alias("revenue")]
    for i, name in enumerate((*SEGMENTS, "OTHER")):
        test = line == name if name != "OTHER" else (~line.isin(*SEGMENTS) | line.isNull())
        aggs += [
            F.sum(F.when(test, F.col("units"))).alias(f"units_{i}"),
            F.sum(F.when(test, F.col("revenue"))).cast(B.MONEY).alias(f"revenue_{i}"),
        ]
    rows = revenue.groupBy("region", "quarter", "quarter_start").agg(*aggs)
    months = F.element_at(
        F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair]), F.month("quarter_start"))
    period = F.concat(F.col("quarter"), F.lit(" ("), months, F.lit(")"))
    total = _grouped_money(F.col("revenue"))

    def listed(i: int, name: str) -> Column:
        share = F.round(F.try_divide(F.col(f"revenue_{i}") * 100, F.col("revenue")), 1)
        text = F.concat(
            F.lit(f"{name} "), _text(F.col(f"units_{i}").cast("bigint")), F.lit(" "),
            _grouped_money(F.col(f"revenue_{i}")), F.lit(" "), _text(share.cast("decimal(5,1)")), F.lit("%"))
        return F.when(F.col(f"revenue_{i}").isNotNull(), text)

    text = _page(
        "QUARTERLY SALES REPORT",
        _after("Reporting Period: ", period),
        _after("Region: ", F.col("region")),
        _after("Report Generated: ", _text(F.add_months("quarter_start", 3))),
        "Executive Summary",
        F.concat(
            F.lit("Orders from "), F.col("region"), F.lit(" in "), F.col("quarter"), F.lit(" are listed below. "),
            F.lit("Total revenue came to "), total, F.lit(" with year-over-year growth in most lines. "),
            F.lit("Larger contracts and loyal buyers drove the performance of this quarter.")),
        "Revenue Breakdown by Product Line",
        "Product Line Units Sold Revenue % of Total",
        *[listed(i, name) for i, name in enumerate((*SEGMENTS, "OTHER"))],
        F.concat(F.lit("TOTAL "), total, F.lit(" 100.0%")),
        "Key Observations",
        "Buyers returned more often than a year ago. Recommendations are to widen the product range. "
        "The forecast assumes that prices stay as they are.",
    )
    slug = F.lower(F.replace(F.concat_ws("-", "region", "quarter"), F.lit(" "), F.lit("-")))
    return rows.select(
        _after("report-", slug).alias("doc_id"),
        F.lit(BUCKET).alias("source_bucket"),
        F.concat(F.lit("reports/"), slug, F.lit(".pdf")).alias("source_key"),
        text.alias("text"),
    )


def applications(customer: DataFrame) -> DataFrame:
    """One account application per customer."""
    names = ("c_custkey", "c_mktsegment", "c_nationkey")
    buyers = spread(customer.select(*names), *names)
    n = F.col("c_custkey")
    key = _text(n)
    name = F.concat(
        F.lit("Alex "), F.initcap(F.translate(key, "0123456789", "abcdefghij")))
    day = _text(F.date_add(F.lit("2000-01-01").cast("date"), (n % 700).cast("int")))
    number = F.lpad(_text(n % 10_000_000), 7, "0")
    text = _page(
        "CUSTOMER APPLICATION FORM",
        _after("Application ID: APP-2000-", key),
        _after("Date of Application: ", day),
        F.concat(F.lit("Account Type Requested: "), F.initcap(F.lower("c_mktsegment")), F.lit(" Account")),
        "Personal Information",
        _after("Full Name: ", name),
        _after("Date of Birth: ", _text(F.date_add(F.lit("1950-01-01").cast("date"), (n % 18000).cast("int")))),
        F.concat(F.lit("National ID / SSN: 35202-"), number, F.lit("-8")),
        F.concat(F.lit("Email Address: applicant"), key, F.lit("@example.org")),
        _after("Phone Number: +92-300-", number),
        F.concat(F.lit("Residential Address: House "), _text(n % 90 + 10), F.lit(", Street 4")),
        "Employment Information",
        F.concat(F.lit("Employer: Works "), _text(F.col("c_nationkey")), F.lit(" Limited")),
        "Job Title: Analyst",
        _after("Annual Income: $", F.format_number(30_000 + n % 900 * 100, 0)),
        _after("Years Employed: ", _text(n % 30 + 1)),
        "I certify that these statements are true. I authorize the bank to check them with my employer.",
        _after("Signature: ", name),
        _after("Date: ", day),
    )
    return buyers.select(
        _after("application-", key).alias("doc_id"),
        F.lit(BUCKET).alias("source_bucket"),
        F.concat(F.lit("applications/"), key, F.lit(".pdf")).alias("source_key"),
        text.alias("text"),
    )


def business_documents(tables: dict[str, DataFrame]) -> DataFrame:
    """All three kinds from the tables `lineitem orders customer nation region`."""
    revenue = B.segment_revenue(
        tables["lineitem"], tables["orders"], tables["customer"], tables["nation"], tables["region"])
    return (
        invoices(tables["lineitem"], tables["orders"], tables["customer"])
        .unionByName(sales_reports(revenue))
        .unionByName(applications(tables["customer"]))
    )
