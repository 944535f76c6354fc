"""Forecasts, customer segments and product suggestions from plain aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.plans.marts import single_customers, with_version_in_force
from granary.plans.questions import monthly_sales, with_every_month
from granary.session import stored

EPOCH_YEAR = 2000


def month_number(month: Column) -> Column:
    return (F.year(month) - EPOCH_YEAR) * 12 + F.month(month)


def trend(series: DataFrame, value: str, keys: list[str], horizon: int) -> DataFrame:
    """Fit a straight line to a monthly series per key and continue it for some months."""
    x = month_number(F.col("month"))
    models = series.groupBy(*keys).agg(
        F.regr_slope(F.col(value), x).alias("slope"),
        F.regr_intercept(F.col(value), x).alias("intercept"),
        F.max("month").alias("last"),
    )
    ahead = models.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    month = F.add_months("last", F.col("step"))
    forecast = F.col("intercept") + F.col("slope") * month_number(month)
    return ahead.select(*keys, month.alias("month"), F.round(forecast, 0).alias("forecast"))


def sales_forecast(sales: DataFrame, horizon: int = 3) -> DataFrame:
    """Expected sales of the next months."""
    return trend(monthly_sales(sales), "total_sales", [], horizon)


def line_items(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Items sold per product line in every month from its first to its last."""
    items = (
        with_version_in_force(sales, products)
        .where(F.col("product_line").isNotNull())
        .groupBy("product_line", F.trunc("order_date", "month").alias("month"))
        .agg(F.sum("quantity").alias("items"))
    )
    return with_every_month(items, "items", ["product_line"])


def demand_forecast(sales: DataFrame, products: DataFrame, horizon: int = 3) -> DataFrame:
    """Expected items sold per product line in the next months."""
    return trend(line_items(sales, products), "items", ["product_line"], horizon)


def customer_activity(sales: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Recency, frequency and spend of every customer with dated sales."""
    dated = sales.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
    return dated.groupBy("customer_id").agg(
        F.datediff(F.lit(run_ts.date()), F.max("order_date")).alias("days_since_order"),
        F.count_distinct("order_number").alias("orders"),
        F.sum("sales_amount").alias("total_sales"),
    )


def customer_segments(sales: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Customers split by recency, frequency and spend, each against the average customer."""
    activity = customer_activity(sales, run_ts)

    def average(name: str) -> Column:
        return activity.agg(F.avg(name)).scalar()

    parts = [
        F.when(F.col("days_since_order") <= average("days_since_order"), "recent").otherwise("lapsed"),
        F.when(F.col("orders") >= average("orders"), "frequent").otherwise("rare"),
        F.when(F.col("total_sales") >= average("total_sales"), "high").otherwise("low"),
    ]
    return activity.select("*", F.concat_ws("-", *parts).alias("segment"))


def with_region(pairs: DataFrame, located: DataFrame) -> DataFrame:
    """pairs of customers whose region is known, with the region."""
    return pairs.join(located.where(F.col("region").isNotNull()), "customer_id")


def ranked_products(pairs: DataFrame) -> DataFrame:
    """Rank of each product in its region by items sold, then by key, without sorting a region in one task.

    Regions are sorted over all tasks at once. A rank is what the tasks before hold of the region, and the place in the task.
    """
    sold = pairs.groupBy("region", "product_key").agg(F.sum("items").alias("items"))
    laid = stored(sold.repartitionByRange("region", F.desc("items"), "product_key").withColumn("part", F.spark_partition_id()), "ranked")
    counts = laid.groupBy("region", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("region").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("region", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("region", "part").orderBy(F.desc("items"), "product_key"))
    placed = laid.select("region", "part", "product_key", place.alias("place"))
    return placed.join(before, ["region", "part"]).select("region", "product_key", (F.col("before") + F.col("place")).alias("rank"))


def bought(sales: DataFrame) -> DataFrame:
    """Items of every product that a customer has bought."""
    known = sales.where(F.col("customer_id").isNotNull() & F.col("product_key").isNotNull())
    return known.groupBy("customer_id", "product_key").agg(F.sum("quantity").alias("items"))


def recommendations(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """For each customer the best-selling product of their region that they have not bought; NULL if there is none.

    That is the first gap in the ranks of what they own.
    """
    located = stored(single_customers(customers).select("customer_id", "region"), "located")
    pairs = stored(with_region(bought(sales), located), "bought")  # read twice, so the regions are looked up before
    ranked = ranked_products(pairs)
    owned = pairs.join(ranked, ["region", "product_key"]).select("customer_id", "rank")
    place = F.row_number().over(Window.partitionBy("customer_id").orderBy("rank"))
    gaps = owned.withColumn("place", place).groupBy("customer_id").agg(
        F.coalesce(F.min(F.when(F.col("rank") != F.col("place"), F.col("place"))), F.count(F.lit(1)) + 1).alias("rank")
    )
    wanted = located.join(gaps, "customer_id", "left").select("customer_id", "region", F.coalesce("rank", F.lit(1)).alias("rank"))
    offers = wanted.join(ranked, ["region", "rank"], "left")
    return offers.select("customer_id", "product_key", F.when(F.col("product_key").isNotNull(), F.col("rank")).alias("rank"))
