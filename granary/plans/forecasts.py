"""Segments, predictions and forecasts from models fitted to the marts, and how well they do."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.models import als, control, evaluation, kmeans, ridge, season, tree
from granary.plans.marts import days_to_ship, is_late_shipment, single_customers, usable_sales, with_version_in_force
from granary.plans.predictions import bought, customer_activity, line_items, ranked_products, with_region
from granary.plans.questions import DRIVERS, customer_spend, monthly_sales
from granary.session import stored

SEGMENT_FEATURES = ["days_since_order", "orders", "total_sales"]
SEGMENTS = 5
HORIZON = 3
SCORE_BIN = 1.0  # money
OFFERS = 30  # best-selling products of a region that are ranked for a customer


def segments(sales: DataFrame, run_ts: dt.datetime, k: int = SEGMENTS) -> DataFrame:
    """Customers in k groups by recency, frequency and spend; the group that spends most is number 0."""
    found, clusters = kmeans.clustered(customer_activity(sales, run_ts), "customer_id", SEGMENT_FEATURES, k, "segment")
    far = clusters.nearest()["d"] if clusters.centres else F.lit(None).cast("double")
    return found.select("customer_id", *SEGMENT_FEATURES, "segment", F.round(far, 6).alias("squared_distance"))


def sales_features() -> dict[str, Column]:
    """Features of a sale that are known when it is made, centred near zero."""
    numbers = {"quantity": 0, "product_cost": 0, "product_age_days": 0, "customer_age": 50, "days_until_due": 0}
    flags = ["order_is_weekend", "is_product_active", "missing_customer_age", "missing_product_cost"]
    shifted = {name: F.coalesce(F.col(name), F.lit(shift)) - shift for name, shift in numbers.items()}
    months = {f"quarter_{q}": (F.col("order_quarter") == q).cast("int") for q in (2, 3, 4)}
    return {**shifted, **{name: F.col(name).cast("int") for name in flags}, **months}


NEEDED = ["quantity", "product_cost", "product_age_days", "customer_age", "days_until_due", "order_is_weekend", "is_product_active",
          "missing_customer_age", "missing_product_cost", "order_quarter", "order_year"]


def trained(features: DataFrame, split: Column | None = None) -> tuple[DataFrame, ridge.Line]:
    """The sales with what the regression needs, and the regression over those that split selects (all by default)."""
    rows = stored(features.select("order_number", "product_key", "sales_amount", *NEEDED), "features")
    return rows, ridge.fitted(rows if split is None else rows.where(split), sales_features(), F.col("sales_amount"))


def sales_regression(features: DataFrame) -> DataFrame:
    """The coefficient of every feature; the intercept has the name `intercept`."""
    _, line = trained(features)
    rows = [("intercept", line.intercept), *line.coefficients.items()]
    df = features.sparkSession.createDataFrame([(name, value, line.rows) for name, value in rows], "feature string, coefficient double, sales long")
    return df.withColumn("coefficient", F.round("coefficient", 4))


def sales_prediction(features: DataFrame) -> DataFrame:
    """Every sale with the amount that its features let expect."""
    rows, line = trained(features)
    return rows.select("order_number", "product_key", "sales_amount", F.round(line.predicted(sales_features()), 3).alias("predicted"))


def regression_quality(features: DataFrame) -> DataFrame:
    """Per year: a regression over the years before, its errors, and how well its scores rank sales above their average.

    The first year has nothing before it. The number of years is that of the calendar.
    """
    rows = stored(features.select("order_number", "product_key", "sales_amount", *NEEDED), "features")
    dated = rows.where("order_year is not null")
    years = sorted(r[0] for r in dated.select("order_year").distinct().collect())
    expected, predictors = F.lit(None).cast("double"), sales_features()
    moments = ridge.moments_by(dated, F.col("order_year"), predictors, F.col("sales_amount"))  # all years in one pass
    for year in years[1:]:
        before = ridge.added([sums for earlier, sums in moments.items() if earlier < year], len(predictors))
        line = ridge.line(before, predictors)
        expected = F.when(F.col("order_year") == year, line.predicted(predictors)).otherwise(expected)
    scored = rows.select("order_year", "sales_amount", expected.alias("expected")).where(F.col("expected").isNotNull())
    off = F.col("expected") - F.col("sales_amount")
    errors = scored.groupBy("order_year").agg(
        F.avg("sales_amount").alias("average"), F.round(F.avg(F.abs(off)), 3).alias("mean_error"),
        F.round(1 - F.sum(off * off) / F.nullif(F.var_pop("sales_amount") * F.count(F.lit(1)), F.lit(0.0)), 6).alias("explained"),
    )
    above = scored.join(errors.select("order_year", "average"), "order_year")
    bins = evaluation.score_bins(above, F.col("expected"), F.col("sales_amount") > F.col("average"), SCORE_BIN, [F.col("order_year")])
    ranked = evaluation.rank_quality(bins, ["order_year"])
    return errors.drop("average").join(ranked, "order_year")


def seasonal_forecast(sales: DataFrame, products: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Expected items sold per product line in the next months, with their season."""
    return season.forecast(line_items(sales, products), "items", ["product_line"], horizon)


def forecast_quality(sales: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Errors of all forecasts of total sales, from every month that has two years before it."""
    return evaluation.backtest(monthly_sales(sales), "total_sales", [], horizon)


def demand_forecast_quality(sales: DataFrame, products: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """The same for the items of each product line."""
    return evaluation.backtest(line_items(sales, products), "items", ["product_line"], horizon)


def suggestions(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """For each customer the product that suits them best among the best-selling ones of their region that they have not bought.

    How a product suits is the product of factors; a customer or product without any counts 0, and equals go by rank. The
    product is NULL if the region is unknown or all its offers are owned. There are OFFERS offers for each of the fixed regions.
    """
    pairs = stored(bought(sales), "bought")
    model = als.fitted(pairs, "customer_id", "product_key", "items")
    located = stored(single_customers(customers).select("customer_id", "region"), "located")
    ranked = ranked_products(with_region(pairs, located)).where(F.col("rank") <= OFFERS)
    offers = stored(ranked.join(model.items.withColumnRenamed("factors", "v"), "product_key", "left"), "offers")
    owned = pairs.select("customer_id", "product_key").join(F.broadcast(offers.select("product_key").distinct()), "product_key")
    open_ = located.join(F.broadcast(offers), "region").join(owned, ["customer_id", "product_key"], "left_anti")
    suits = F.coalesce(als.dot(F.col("u"), F.col("v")), F.lit(0.0))
    scored = open_.join(model.users.withColumnRenamed("factors", "u"), "customer_id", "left").select("customer_id", "product_key", "rank", suits.alias("suits"))
    best = scored.groupBy("customer_id").agg(F.max_by(F.struct("product_key", "rank", "suits"), F.struct("suits", -F.col("rank"))).alias("best"))
    return located.join(best, "customer_id", "left").select(
        "customer_id", F.col("best.product_key").alias("product_key"), F.col("best.rank").alias("rank"), F.round("best.suits", 6).alias("suits"))


def factor_losses(sales: DataFrame) -> DataFrame:
    """The loss of the factors after every round; it never rises."""
    losses = als.fitted(bought(sales), "customer_id", "product_key", "items", with_losses=True).losses
    return sales.sparkSession.createDataFrame([(i + 1, loss) for i, loss in enumerate(losses)], "round int, loss double").withColumn("loss", F.round("loss", 4))


def spend_tree(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Which attributes split customers by what they spend, one after the other."""
    buyers = customer_spend(sales).join(single_customers(customers).select("customer_id", *DRIVERS, "age"), "customer_id")
    return tree.described(buyers, "total_sales", [*DRIVERS, "age"], ordered=["age"])


def delivery_shifts(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Days on which the share of late sales, or the days to ship, of a category left its level."""
    delays = with_version_in_force(usable_sales(sales), products).select("product_category_name", "order_date", days_to_ship(), is_late_shipment())
    daily = delays.groupBy("product_category_name", "order_date").agg(F.avg("days_to_ship").alias("days_to_ship"), F.avg("is_late_shipment").alias("late_share"))
    measures = daily.unpivot(["product_category_name", "order_date"], ["days_to_ship", "late_share"], "measure", "value")
    return control.shifts(measures, "order_date", "value", ["product_category_name", "measure"])
