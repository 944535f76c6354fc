"""Business metrics over the star schema.

``measures`` arguments are rows with a ``fact_rows`` weight, see ``marts.sales_measures``; ``measures_of`` gives the
same shape to an existing fact table, one row each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.dates import moment


def measures_of(fact: DataFrame) -> DataFrame:
    return fact.withColumn("fact_rows", F.lit(1).cast("bigint"))


def weighted_sum(column: str) -> Column:
    return F.sum(F.col(column) * F.col("fact_rows"))


def average_price() -> Column:
    known = F.when(F.col("price").isNotNull(), F.col("fact_rows"))
    return F.round(weighted_sum("price") / F.sum(known), 2)


def total_sales(measures: DataFrame) -> DataFrame:
    return measures.agg(weighted_sum("sales_amount").alias("total_sales"))


def total_items(measures: DataFrame) -> DataFrame:
    return measures.agg(weighted_sum("quantity").alias("total_items"))


def avg_price(measures: DataFrame) -> DataFrame:
    return measures.agg(average_price().alias("avg_sales"))


def total_orders(sales: DataFrame) -> DataFrame:
    """Distinct orders. Lookups never remove a sale, so the sales table alone answers this."""
    return sales.agg(F.count_distinct("order_number").alias("total_orders"))


def total_products(products: DataFrame) -> DataFrame:
    return products.agg(F.count_distinct("product_name").alias("total_products"))


def total_customers(customers: DataFrame) -> DataFrame:
    return customers.agg(F.count("customer_key").alias("total_customers"))


def total_buyers(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """Distinct known customers with a sale."""
    return buyers(customers, sales).agg(F.count_distinct("customer_key").alias("total_customers"))


def buyers(customers: DataFrame, sales: DataFrame) -> DataFrame:
    ids = sales.select("customer_id").distinct()
    return customers.join(ids, "customer_id", "left_semi")


def order_span(sales: DataFrame) -> DataFrame:
    """First and last order date and the completed years between them."""
    first, last = F.min("order_date"), F.max("order_date")
    return sales.agg(
        first.alias("first_order_date"),
        last.alias("last_order_date"),
        F.timestamp_diff("YEAR", first, last).alias("order_range_years"),
    )


def customer_age_span(customers: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Completed years since the latest and the earliest birth date."""
    return customers.agg(
        F.timestamp_diff("YEAR", F.max("birth_date"), moment(run_ts)).alias("youngest_age"),
        F.timestamp_diff("YEAR", F.min("birth_date"), moment(run_ts)).alias("oldest_age"),
    )


def countries(customers: DataFrame) -> DataFrame:
    return customers.select("country").distinct()


def product_hierarchy(products: DataFrame) -> DataFrame:
    return products.select("category", "subcategory", "product_name").distinct()


def business_report(measures: DataFrame, customers: DataFrame, products: DataFrame, sales: DataFrame) -> DataFrame:
    """Key figures, one per row; each table is aggregated once. Products and customers count rows, not names."""
    return (
        report_lines(measures, {
            "Total Sales": weighted_sum("sales_amount"),
            "Total Items Sold": weighted_sum("quantity"),
            "Average Sales": average_price(),
            "Total Nr. Orders": F.count_distinct("order_number"),
        })
        .unionByName(report_lines(products, {"Total Nr. Products": F.count("product_name")}))
        .unionByName(report_lines(customers, {"Total Nr. Customers": F.count("customer_key")}))
        .unionByName(report_lines(buyers(customers, sales), {
            "Total Customers with Orders": F.count_distinct("customer_key"),
        }))
    )


def report_lines(df: DataFrame, figures: dict[str, Column]) -> DataFrame:
    """Aggregate once, then turn the figures into rows."""
    totals = df.agg(*[figure.cast("double").alias(f"_{i}") for i, figure in enumerate(figures.values())])
    lines = [
        F.struct(F.lit(name).alias("measure_name"), F.col(f"_{i}").alias("measure_value"))
        for i, name in enumerate(figures)
    ]
    return totals.select(F.inline(F.array(*lines)))
