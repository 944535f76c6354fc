"""Star schema: customer, product and calendar dimensions, sales facts and the feature table.

Dimensions carry no broadcast hint: they grow with the data, so Spark decides by their measured size at run time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from granary.functions import dates, numbers
from granary.operators.joins import left_lookup, unique_lookup


def dim_customer(customers: DataFrame, people: DataFrame, locations: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Customers with ERP demographics and location, both optional.

    ERP gender wins whenever an ERP row exists, even a missing-marker one. Repeated ERP ids repeat the customer.
    """
    people = people.select(
        F.col("customer_id").alias("_person"), F.col("gender").alias("_gender"), "birth_date", "age", "age_group"
    )
    locations = locations.select(F.col("customer_id").alias("_resident"), "country", "region")
    with_person = left_lookup(customers, people, "customer_key", "_person")
    full = left_lookup(with_person, locations, "customer_key", "_resident")
    return full.select(
        *CUSTOMER_MASTER,
        F.coalesce("_gender", "gender").alias("gender"),
        "birth_date",
        "age",
        "age_group",
        "country",
        "region",
        processed_at(run_ts),
    )


CUSTOMER_MASTER = ["customer_id", "customer_key", "first_name", "last_name", "marital_status", "created_date"]


def dim_product(products: DataFrame, categories: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Product versions with their category hierarchy."""
    hierarchy = categories.select("category_id", "category", "subcategory", "requires_maintenance")
    joined = left_lookup(products.drop("ingest_timestamp"), hierarchy, "product_category", "category_id")
    return joined.drop("category_id").select("*", processed_at(run_ts))


def processed_at(run_ts: dt.datetime) -> Column:
    return dates.moment(run_ts).alias("gold_processed_timestamp")


def fixed_bounds(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Calendar bounds given by configuration."""
    return spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))


def spanned_years(df: DataFrame, day: str) -> DataFrame:
    """Calendar bounds covering every year in which a date column has a value."""
    year_start = F.trunc(F.max(day), "year")
    return df.agg(
        F.trunc(F.min(day), "year").alias("first"), F.date_sub(F.add_months(year_start, 12), 1).alias("last")
    )


def dim_calendar(bounds: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """One row per day between two bounds, with its parts and labels."""
    day = F.col("date")
    weekend = F.dayofweek(day).isin(1, 7)
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        "date",
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        F.date_format(day, "EEEE").alias("day_of_week"),
        F.date_format(day, "EEE").alias("day_of_week_abbr"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMMM yyyy").alias("month_year"),
        F.quarter(day).alias("quarter"),
        F.format_string("Q%d %d", F.quarter(day), F.year(day)).alias("quarter_year"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofyear(day).alias("day_of_year"),
        (~weekend).alias("is_weekday"),
        weekend.alias("is_weekend"),
        dates.moment(run_ts).alias("silver_processed_timestamp"),
    )


# The output columns of facts and features.
SALES = ["order_number", "customer_id", "product_key", "order_date", "ship_date", "due_date", "sales_amount",
         "quantity", "price"]
# Dimension column -> fact column
CUSTOMER = {
    "customer_key": "customer_key",
    "first_name": "first_name",
    "last_name": "last_name",
    "marital_status": "marital_status",
    "gender": "customer_gender",
    "birth_date": "customer_birth_date",
    "age": "customer_age",
    "age_group": "customer_age_group",
    "country": "customer_country",
    "region": "customer_region",
}
PRODUCT = {
    "product_id": "product_id",
    "product_category": "product_category",
    "product_name": "product_name",
    "product_cost": "product_cost",
    "product_line": "product_line",
    "product_start_date": "product_start_date",
    "product_end_date": "product_end_date",
    "category": "product_category_name",
    "subcategory": "product_subcategory",
    "requires_maintenance": "product_requires_maintenance",
}
CALENDAR = {
    "year": "order_year",
    "month": "order_month",
    "day_of_month": "order_day",
    "day_of_week": "order_day_of_week",
    "month_name": "order_month_name",
    "quarter": "order_quarter",
    "is_weekend": "order_is_weekend",
}


def renamed(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """A dimension reduced to its join key (as ``_key``) and its fact columns."""
    return df.select(F.col(key).alias("_key"), *[F.col(old).alias(new) for old, new in columns.items()])


def single_customers(customers: DataFrame) -> DataFrame:
    """One row per customer id. The dimension repeats a customer whose ERP id repeats; the first row by all columns counts,
    where a known value comes before an unknown one."""
    known = customers.where(F.col("customer_id").isNotNull())
    ranked = F.struct(*[F.struct(F.col(c).isNull().alias("absent"), F.col(c).alias("value")).alias(c) for c in CUSTOMER])
    first = known.groupBy("customer_id").agg(F.min(ranked).alias("_first"))
    return first.select("customer_id", *[F.col(f"_first.{c}.value").alias(c) for c in CUSTOMER])


def with_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with the attributes of each row of their customer."""
    return left_lookup(sales, renamed(customers, "customer_id", CUSTOMER), "customer_id", "_key").drop("_key")


def with_single_customer(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with the attributes of their customer, who counts once."""
    return unique_lookup(sales, renamed(single_customers(customers), "customer_id", CUSTOMER), "customer_id", "_key").drop("_key")


def with_every_version(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with the attributes of each version of their product."""
    return left_lookup(sales, renamed(products, "product_key", PRODUCT), "product_key", "_key").drop("_key")


def with_version_in_force(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with the attributes of the product version that was valid on the order date.

    A key of sales may belong to products of several categories. All their versions follow each other by start date, and
    of those with equal start dates the one of the largest product id counts, so one version is in force on a day.
    """
    start, day = F.col("product_start_date"), F.col("order_date")
    versions = renamed(products.where(start.isNotNull()), "product_key", PRODUCT)
    others = [c for c in versions.columns if c not in ("_key", "product_start_date")]
    single = versions.groupBy("_key", "product_start_date").agg(F.max(F.struct(*others)).alias("_last"))
    chain = single.select(
        "_key", "product_start_date", "_last.*",
        F.lead("product_start_date").over(Window.partitionBy("_key").orderBy("product_start_date")).alias("_next"),
    )
    in_force = (day >= start) & (F.col("_next").isNull() | (day < F.col("_next")))
    return sales.join(chain, (F.col("product_key") == F.col("_key")) & in_force, "left").drop("_key", "_next")


def with_calendar(sales: DataFrame, calendar: DataFrame) -> DataFrame:
    """Sales with the calendar attributes of the order date; NULL outside the calendar."""
    days = renamed(calendar, "date", CALENDAR)
    return sales.join(days, F.col("order_date") == F.col("_key"), "left").drop("_key")


def fact_columns(sales: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return sales.select(*SALES, *CUSTOMER.values(), *PRODUCT.values(), *CALENDAR.values(), processed_at(run_ts))


# The customer dimension is the one most likely to need a shuffle, so it is looked up while the rows are still narrow.


def fact_sales(sales: DataFrame, customers: DataFrame, products: DataFrame, calendar: DataFrame,
               run_ts: dt.datetime) -> DataFrame:
    """Sales with all dimension attributes. Each sale meets every version of its product, whatever the order date."""
    by_customer = with_customer(sales.select(*SALES), customers)
    return fact_columns(with_calendar(with_every_version(by_customer, products), calendar), run_ts)


def fact_sales_effective(sales: DataFrame, customers: DataFrame, products: DataFrame, calendar: DataFrame,
                         run_ts: dt.datetime) -> DataFrame:
    """Sales with the product version in force on the order date and one row per customer: one row per sale."""
    return fact_columns(with_calendar(effective_star(sales, customers, products), calendar), run_ts)


def effective_star(sales: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per sale, with its customer and the product version in force, but nothing that follows from these columns."""
    return with_version_in_force(with_single_customer(sales.select(*SALES), customers), products)


def repeated_keys(dimension: DataFrame, key: str) -> DataFrame:
    """The keys that a dimension holds more than once, with their number of rows."""
    counts = dimension.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > 1)


def sales_measures(sales: DataFrame, repeated_customers: DataFrame, repeated_products: DataFrame) -> DataFrame:
    """The measures of ``fact_sales`` without building it: one row per sale and the number of fact rows it stands for.

    Takes the repeated keys of the dimensions: a key that is there once, or not at all, gives one fact row anyway. The
    calendar has one row per day and does not change row counts.
    """
    customers = repeated_customers.select(F.col("_key").alias("customer_id"), F.col("_rows").alias("_customers"))
    products = repeated_products.select(F.col("_key").alias("product_key"), F.col("_rows").alias("_products"))
    return sales.join(products, "product_key", "left").join(customers, "customer_id", "left").select(
        "order_number", "sales_amount", "quantity", "price",
        (F.coalesce("_products", F.lit(1)) * F.coalesce("_customers", F.lit(1))).alias("fact_rows"),
    )


# Feature columns in their order.
FEATURE_GROUPS = {
    "dates": ["order_year", "order_month", "order_day", "order_quarter", "order_month_name", "order_day_of_week",
              "order_is_weekend"],
    "customer": ["customer_key", "first_name", "last_name", "customer_gender", "customer_age", "customer_age_group",
                 "customer_birth_date", "marital_status", "customer_country", "customer_region"],
    "product": ["product_id", "product_name", "product_category", "product_subcategory", "product_line",
                "product_cost", "product_category_name", "product_requires_maintenance", "product_start_date",
                "product_end_date"],
}
CLUSTER_KEYS = ["customer_id", "order_year", "order_month"]


def cluster_keys(sales: DataFrame) -> DataFrame:
    """The keys by which features of these sales are clustered, without any dimension."""
    return keyed(usable_sales(sales)).select(*CLUSTER_KEYS)


def keyed(sales: DataFrame) -> DataFrame:
    """Sales with the keys by which their features are clustered."""
    day = F.col("order_date")
    return sales.withColumns({"order_year": F.year(day), "order_month": F.month(day)})


def laid_features(laid: DataFrame, calendar: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """The features of usable rows of the star, where these lie: the calendar, bounded by its years, goes to every task."""
    dated = with_calendar(laid.drop(*CALENDAR.values()), F.broadcast(calendar))
    return fact_sales_ml(fact_columns(dated, run_ts), run_ts)


def usable_sales(sales: DataFrame) -> DataFrame:
    """Sales with a known order date and positive price, amount and quantity."""
    positive = (F.col("price") > 0) & (F.col("sales_amount") > 0) & (F.col("quantity") > 0)
    return sales.where(positive & F.col("order_date").isNotNull())


def days_to_ship() -> Column:
    return F.datediff(F.col("ship_date"), F.col("order_date")).alias("days_to_ship")


def is_late_shipment() -> Column:
    """1 unless the goods are known to have been shipped by the due date."""
    in_time = F.coalesce(F.col("ship_date") <= F.col("due_date"), F.lit(False))
    return numbers.indicator(~in_time).alias("is_late_shipment")


def fact_sales_ml(fact: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Feature table: usable sales plus derived delivery, price, profit and product-age features."""
    ordered, shipped, due = F.col("order_date"), F.col("ship_date"), F.col("due_date")
    price, cost, quantity = F.col("price"), F.col("product_cost"), F.col("quantity")
    retired = F.coalesce(ordered > F.col("product_end_date"), F.lit(False))
    return usable_sales(fact).select(
        *SALES[:6],
        *FEATURE_GROUPS["dates"],
        *SALES[6:],
        days_to_ship(),
        F.datediff(due, ordered).alias("days_until_due"),
        is_late_shipment(),
        numbers.unit_price(F.col("sales_amount"), quantity).alias("price_per_unit"),
        numbers.margin_pct(price, cost).alias("profit_margin_pct"),
        numbers.profit(price, cost, quantity).alias("estimated_profit"),
        *FEATURE_GROUPS["customer"],
        *FEATURE_GROUPS["product"],
        F.datediff(ordered, F.col("product_start_date")).alias("product_age_days"),
        numbers.indicator(~retired).alias("is_product_active"),
        numbers.indicator(shipped.isNull()).alias("missing_ship_date"),
        numbers.indicator(F.col("customer_age").isNull()).alias("missing_customer_age"),
        numbers.indicator(F.coalesce(cost, F.lit(0)) == 0).alias("missing_product_cost"),
        dates.moment(run_ts).alias("ml_processed_timestamp"),
    )
