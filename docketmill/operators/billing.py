"""Totals behind business documents, computed from order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from docketmill.functions.text import round_half_even

TAX_RATE = "0.17"  # fixed value
TOTAL = "TOTAL"
MONEY = "decimal(18,2)"


def order_totals(lineitem: DataFrame) -> DataFrame:
    """Quantity and revenue of each order, split by return flag.

    The flags are a fixed domain, so the lines of an order are sums in one row
    rather than a collected list, and a huge order is merged map-side.
    """
    price = F.col("l_extendedprice").cast(MONEY)
    flag = F.col("l_returnflag")
    other = ~flag.isin("A", "N", "R") | flag.isNull()
    aggs = [
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_quantity").alias("units"),
        F.sum(price).alias("subtotal"),
    ]
    for name, test in (("a", flag == "A"), ("n", flag == "N"), ("r", flag == "R"), ("o", other)):
        aggs += [
            F.sum(F.when(test, F.col("l_quantity"))).alias(f"qty_{name}"),
            F.sum(F.when(test, price)).alias(f"amount_{name}"),
        ]
    return lineitem.groupBy(F.col("l_orderkey").alias("order_key")).agg(*aggs)


def tax_of(subtotal: Column) -> Column:
    return F.round(subtotal * F.lit(TAX_RATE).cast("decimal(3,2)"), 2)


def invoice_totals(lineitem: DataFrame) -> DataFrame:
    """`(order_key, lines, subtotal, tax, total)` per order, summed exactly in decimals."""
    price = F.col("l_extendedprice").cast(MONEY)
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(price).alias("subtotal"))
    return per_order.withColumn("tax", tax_of(F.col("subtotal"))).withColumn(
        "total", F.col("subtotal") + F.col("tax"))


def quarter_label(date: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(date).cast("string"), F.lit(" "), F.year(date).cast("string"))


def segment_revenue(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """`(region, quarter, quarter_start, product_line, units, revenue)`.

    Each side is reduced before the next join: lines to orders, then orders to
    one row per customer and quarter, so a customer with very many orders joins
    as a handful of rows.
    """
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("units"),
        F.sum(F.col("l_extendedprice").cast(MONEY)).alias("revenue"),
    )
    per_customer = orders.select(
        "o_orderkey", "o_custkey", F.date_trunc("quarter", "o_orderdate").cast("date").alias("quarter_start")
    ).join(per_order, "o_orderkey").groupBy("o_custkey", "quarter_start").agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
    place = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("r_name").alias("region"))
    buyers = customer.select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("product_line"))
    placed = per_customer.join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    # Nations are few: sum per nation first, then look up the region.
    per_nation = placed.groupBy("c_nationkey", "quarter_start", "product_line").agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue"))
    return per_nation.join(place, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(
        "region", "quarter_start", "product_line"
    ).agg(F.sum("units").alias("units"), F.sum("revenue").cast(MONEY).alias("revenue")).withColumn(
        "quarter", quarter_label(F.col("quarter_start")))


def revenue_breakdown(revenue: DataFrame) -> DataFrame:
    """Product lines of each report with their share, plus a TOTAL row.

    The input is `segment_revenue`, already a few rows per report.
    """
    rolled = revenue.groupBy("region", "quarter", F.col("product_line")).agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue")
    ).rollup("region", "quarter", "product_line").agg(
        F.sum("units").alias("units"),
        F.sum("revenue").alias("revenue"),
        F.grouping_id().alias("_level"),
    ).filter(F.col("_level") <= 1)
    report = W.partitionBy("region", "quarter")
    total = F.max(F.when(F.col("_level") == 1, F.col("revenue"))).over(report)
    share = F.when(total != 0, F.col("revenue").cast("double") / total.cast("double") * 100)
    return rolled.select(
        "region",
        "quarter",
        F.when(F.col("_level") == 1, F.lit(TOTAL)).otherwise(F.col("product_line")).alias("product_line"),
        "units",
        "revenue",
        round_half_even(share, 1).alias("percent"),
    )
