"""Business questions answered from sales with the product version in force at the order date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.plans.marts import days_to_ship, is_late_shipment, single_customers, usable_sales, with_version_in_force


def percent(part: Column, whole: Column) -> Column:
    """Share in percent with two decimals; NULL for an empty whole."""
    return F.round(part.cast("double") * 100 / F.nullif(whole, F.lit(0)), 2)


def top_products(sales: DataFrame, products: DataFrame, limit: int = 10) -> DataFrame:
    """Product versions with the highest sales."""
    return (
        with_version_in_force(sales, products)
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id", "product_name")
        .agg(F.sum("sales_amount").alias("total_sales"), F.sum("quantity").alias("total_items"))
        .orderBy(F.desc("total_sales"), "product_id", "product_name")
        .limit(limit)
    )


def top_customers(sales: DataFrame, customers: DataFrame, limit: int = 10) -> DataFrame:
    """Known customers with the highest sales. Sales are summed per customer before they meet the customer table."""
    spend = sales.groupBy("customer_id").agg(
        F.sum("sales_amount").alias("total_sales"), F.count_distinct("order_number").alias("orders")
    )
    best = (
        spend.join(customers.select("customer_id"), "customer_id", "left_semi")
        .orderBy(F.desc("total_sales"), "customer_id")
        .limit(limit)
    )
    return best.join(
        single_customers(customers).select("customer_id", "customer_key", "first_name", "last_name", "country"), "customer_id"
    )


def with_every_month(series: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """A monthly series per key with 0 in the months between its first and its last that it lacks."""
    bounds = series.groupBy(*keys).agg(F.min("month").alias("first"), F.max("month").alias("last"))
    spine = bounds.where(F.col("first").isNotNull()).select(*keys, F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return spine.join(series, [*keys, "month"], "left").select(*keys, "month", F.coalesce(value, F.lit(0)).alias(value))


def monthly_sales(sales: DataFrame) -> DataFrame:
    """Sales of every month from the first to the last; 0 in a month without any."""
    months = sales.groupBy(F.trunc("order_date", "month").alias("month")).agg(F.sum("sales_amount").alias("total_sales"))
    # undated sales are one group; a filter before would repeat the date rules of the cleaner for every row
    return with_every_month(months.where(F.col("month").isNotNull()), "total_sales", [])


def monthly_growth(sales: DataFrame) -> DataFrame:
    """Sales per month and their change against the month before. The window holds one row per month."""
    before = F.lag("total_sales").over(Window.orderBy("month"))
    return monthly_sales(sales).select(
        "month",
        "total_sales",
        before.alias("previous_sales"),
        percent(F.col("total_sales") - before, before).alias("growth_pct"),
    )


def sales_trend(sales: DataFrame, months: int = 3) -> DataFrame:
    """Sales per month with a moving average and the running total."""
    in_order = Window.orderBy("month")
    recent = in_order.rowsBetween(1 - months, 0)
    return monthly_sales(sales).select(
        "month",
        "total_sales",
        F.round(F.avg("total_sales").over(recent), 2).alias("moving_average"),
        F.sum("total_sales").over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("running_total"),
    )


def customer_spend(sales: DataFrame) -> DataFrame:
    """Sales per customer id; shrinks the fact before any lookup."""
    return sales.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum("sales_amount").alias("total_sales"), F.count(F.lit(1)).alias("sales_lines")
    )


def weak_regions(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales per region, compared with the average region."""
    per_region = (
        customer_spend(sales)
        .join(single_customers(customers).select("customer_id", "region"), "customer_id")
        .where(F.col("region").isNotNull())
        .groupBy("region")
        .agg(F.sum("total_sales").alias("total_sales"))
    )
    everywhere = Window.partitionBy()
    regions, total = F.count("region").over(everywhere), F.sum("total_sales").over(everywhere)
    return per_region.select(
        "region",
        "total_sales",
        percent(F.col("total_sales") * regions, total).alias("pct_of_average"),
        (F.col("total_sales") * regions < total).alias("is_below_average"),
    )


DRIVERS = ["age_group", "region", "gender", "marital_status"]


def spend_drivers(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Average spend per customer for each value of each customer attribute, in one pass over customers."""
    buyers = customer_spend(sales).join(single_customers(customers).select("customer_id", *DRIVERS), "customer_id")
    attributes = F.array(*[F.struct(F.lit(d).alias("driver"), F.col(d).alias("value")) for d in DRIVERS])
    return (
        buyers.select("total_sales", F.inline(attributes))
        .groupBy("driver", "value")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("total_sales").alias("total_sales"),
            F.round(F.avg("total_sales"), 2).alias("avg_spend"),
        )
    )


def spend_correlation(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """How far age and number of purchases go along with spend."""
    buyers = customer_spend(sales).join(single_customers(customers).select("customer_id", "age"), "customer_id")
    return buyers.agg(
        F.round(F.corr("age", "total_sales"), 6).alias("age_spend_corr"),
        F.round(F.corr("sales_lines", "total_sales"), 6).alias("purchases_spend_corr"),
    )


def category_margin(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, cost and margin per category, over usable sales whose product cost is known."""
    costed = with_version_in_force(usable_sales(sales), products).where(F.col("product_cost") > 0)
    per_category = costed.groupBy("product_category_name").agg(
        F.sum(F.col("price").cast("bigint") * F.col("quantity")).alias("revenue"),
        F.sum(F.col("product_cost").cast("bigint") * F.col("quantity")).alias("cost"),
    )
    return per_category.select(
        "product_category_name",
        "revenue",
        "cost",
        (F.col("revenue") - F.col("cost")).alias("margin"),
        percent(F.col("revenue") - F.col("cost"), F.col("revenue")).alias("margin_pct"),
    )


def ship_delay(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Days from order to shipment per category: median, 90th percentile and share of late sales.

    Exact percentiles keep one counter per distinct day count, which the calendar bounds.
    """
    delays = with_version_in_force(usable_sales(sales), products).select(
        "product_category_name", days_to_ship(), is_late_shipment()
    )
    return delays.groupBy("product_category_name").agg(
        F.count("days_to_ship").alias("shipped"),
        F.round(F.percentile("days_to_ship", F.lit(0.5)), 6).alias("median_days"),
        F.round(F.percentile("days_to_ship", F.lit(0.9)), 6).alias("p90_days"),
        percent(F.sum("is_late_shipment"), F.count(F.lit(1))).alias("late_pct"),
    )
