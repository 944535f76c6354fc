"""Registry of runnable queries: name -> function of (spark, data folder)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import rules
from granary.operators.versions import version_intervals
from granary.plans import classic, forecasts, marts, metrics, predictions, profile, questions, refined
from granary.session import scratch_dir, stored, tuned
from granary.sinks.publish import publish
from granary.sources.csv import read_feed, read_merged, with_lineage
from granary.sources.feeds import dealt_sales, feed
from granary.sources.schemas import FEEDS

RUN_TS = dt.datetime(2025, 1, 1)
CALENDAR = (dt.date(1995, 1, 1), dt.date(2000, 12, 31))
STAMPS = ["ingest_timestamp", "gold_processed_timestamp", "silver_processed_timestamp", "ml_processed_timestamp",
          "silver_load_timestamp"]

Query = Callable[[SparkSession, str], DataFrame]


class Tables:
    """All datasets over one data folder, as lazy plans: a query reads only the columns of the source that it needs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tuned(spark), sf_dir

    def raw(self, name: str) -> DataFrame:
        return feed(self.spark, self.sf_dir, name)

    def silver(self, name: str) -> DataFrame:
        return refined.refined(name, self.raw(name), RUN_TS)

    @cached_property
    def sales(self) -> DataFrame:
        return self.silver("crm_sales")

    @cached_property
    def dated_sales(self) -> DataFrame:
        """The cleaned sales as a written table, as marts and questions find them in the lakehouse.

        Plans that filter or group by the cleaned dates, or read sales twice, start here: on the lazy plan Spark would repeat
        the date rules in every filter. Lines are dealt out before, as a single large file would be cleaned in one task.
        """
        return stored(refined.refined("crm_sales", dealt_sales(self.spark, self.sf_dir), RUN_TS), "sales")

    @cached_property
    def dim_customer(self) -> DataFrame:
        people, locations = self.silver("erp_customer"), self.silver("erp_location")
        return marts.dim_customer(self.silver("crm_customer"), people, locations, RUN_TS)

    @cached_property
    def dim_product(self) -> DataFrame:
        return marts.dim_product(self.silver("crm_product"), self.silver("erp_category"), RUN_TS)

    @cached_property
    def calendar(self) -> DataFrame:
        return marts.dim_calendar(marts.fixed_bounds(self.spark, *CALENDAR), RUN_TS)

    @cached_property
    def written_dimensions(self) -> tuple[DataFrame, DataFrame]:
        """Customers and products as written tables, as facts find them in the lakehouse: a lookup that splits hot keys reads
        its right side three times, and on lazy plans each time would repeat the cleaning and the lookups of the dimension."""
        return stored(self.dim_customer, "customers"), stored(self.dim_product, "products")

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fact_sales(self.sales, *self.written_dimensions, self.calendar, RUN_TS)

    @cached_property
    def effective_fact(self) -> DataFrame:
        return marts.fact_sales_effective(self.sales, self.dim_customer, self.dim_product, self.calendar, RUN_TS)

    @cached_property
    def features(self) -> DataFrame:
        fact = marts.fact_sales_effective(self.dated_sales, self.dim_customer, self.dim_product, self.calendar, RUN_TS)
        return marts.fact_sales_ml(fact, RUN_TS)

    @cached_property
    def dated_fact(self) -> DataFrame:
        return marts.fact_sales(self.dated_sales, *self.written_dimensions, self.calendar, RUN_TS)

    @cached_property
    def measures(self) -> DataFrame:
        repeats = [(self.dim_customer, "customer_id"), (self.dim_product, "product_key")]
        return marts.sales_measures(self.sales, *(marts.repeated_keys(dimension, key) for dimension, key in repeats))

    def with_lineage(self, name: str) -> DataFrame:
        """A raw feed with fixed lineage, as classic plans expect it."""
        return self.raw(name).select(
            "*", F.lit(name).alias("file_name"), F.lit(str(RUN_TS)).cast("timestamp").alias("ingest_datetime")
        )

    def as_csv(self, name: str) -> str:
        """A raw feed written as CSV with its spaces kept; returns the folder."""
        path = f"{scratch_dir(self.spark, 'feed')}/{name}"
        write_csv(self.raw(name), path)
        return path


def write_csv(df: DataFrame, path: str) -> None:
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(header=True, **spaces).csv(path)


def unstamped(df: DataFrame) -> DataFrame:
    return df.drop(*STAMPS)


# --- raw layer -------------------------------------------------------------------------------------------------------


def ingest_csv(name: str, t: Tables) -> DataFrame:
    rows = with_lineage(read_feed(t.spark, t.as_csv(name), FEEDS[name]), RUN_TS)
    return rows.select(*t.raw(name).columns, F.col("corrupt_record").isNotNull().alias("is_corrupt"))


def ingest_corrupt_rows(t: Tables) -> DataFrame:
    """Customer lines of which some carry a bad number or a surplus field; all are kept."""
    customer = F.col("c_custkey")
    line = (
        F.when(customer % 10 == 0, F.concat(F.lit("x"), customer, F.lit(",AW,2020-01-01")))
        .when(customer % 10 == 1, F.concat(customer, F.lit(",AW,2020-01-01,surplus")))
        .otherwise(F.concat(customer, F.lit(",AW,2020-01-01")))
    )
    path = f"{scratch_dir(t.spark, 'feed')}/lines"
    t.spark.read.parquet(f"{t.sf_dir}/customer.parquet").select(line.alias("value")).write.text(path)
    return read_feed(t.spark, path, "cst_id BIGINT, cst_key STRING, cst_create_date DATE", header=False)


def ingest_merged_schema(t: Tables) -> DataFrame:
    """Three location deliveries: usual order, swapped columns, and one without the country."""
    folder = scratch_dir(t.spark, "feed")
    rows = t.raw("erp_location")
    part = F.substr("CID", F.lit(-1)).cast("int") % 3
    layouts = [["CID", "CNTRY"], ["CNTRY", "CID"], ["CID"]]
    paths = [f"{folder}/delivery-{i}" for i in range(len(layouts))]
    for i, (path, columns) in enumerate(zip(paths, layouts)):
        write_csv(rows.where(part == i).select(*columns), path)
    return read_merged(t.spark, paths, FEEDS["erp_location"], RUN_TS).select("CID", "CNTRY")


def peek_raw(t: Tables) -> DataFrame:
    return read_feed(t.spark, t.as_csv("crm_customer"))


# --- refined layer ---------------------------------------------------------------------------------------------------


def refined_table(name: str, t: Tables) -> DataFrame:
    return unstamped(t.silver(name))


def rule_report(name: str, t: Tables) -> DataFrame:
    return rules.report(refined.CLEANERS[name](t.raw(name), RUN_TS), refined.rules(name, RUN_TS))


def dedup_best_record(t: Tables) -> DataFrame:
    kept = refined.best_customers(refined.standardised_customers(t.raw("crm_customer")))
    return kept.select("customer_id", "first_name", "created_date")


def intervals(t: Tables) -> DataFrame:
    products = t.raw("crm_product").select("prd_key", "prd_id", "prd_start_dt", "prd_end_dt")
    return version_intervals(products, "prd_key", "prd_start_dt", "prd_end_dt")


def date_guards(t: Tables) -> DataFrame:
    days = refined.SALES_DAYS
    return refined.guarded_dates(t.raw("crm_sales"), RUN_TS).select("sls_ord_num", *days, *days.values())


def classic_table(name: str, t: Tables) -> DataFrame:
    source, plan = classic.TABLES[name]
    return unstamped(plan(t.with_lineage(source), RUN_TS)).drop("bronze_load_timestamp")


# --- marts and metrics -----------------------------------------------------------------------------------------------


def calendar_of_sales(t: Tables) -> DataFrame:
    return marts.dim_calendar(marts.spanned_years(t.sales, "order_date"), RUN_TS)


def relationships(t: Tables) -> DataFrame:
    sales, customers, products = t.sales, t.silver("crm_customer"), t.silver("crm_product")
    people, locations = t.silver("erp_customer"), t.silver("erp_location")
    return profile.relationship_check({
        "sales.customer_id -> customer.customer_id": (sales, "customer_id", customers, "customer_id"),
        "sales.product_key -> product.product_key": (sales, "product_key", products, "product_key"),
        "location.customer_id -> person.customer_id": (locations, "customer_id", people, "customer_id"),
        "customer.customer_key -> person.customer_id": (customers, "customer_key", people, "customer_id"),
    })


# --- publishing ------------------------------------------------------------------------------------------------------


def published(df: DataFrame, purpose: str, **options) -> DataFrame:
    """Write a table, then scan it by its name."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    name = f"{purpose}_{path[-8:].replace('-', '_').lower()}"
    publish(df, name, path=path, **options)
    return spark.read.table(name)


def publish_roundtrip(t: Tables) -> DataFrame:
    cleaned = refined.clean_crm_sales(t.raw("crm_sales"), RUN_TS)
    return unstamped(published(
        cleaned, "sales", rules=refined.rules("crm_sales", RUN_TS), comment="Cleaned sales",
        properties={"quality": "silver", "layer": "silver"},
    ))


def clustered_roundtrip(t: Tables) -> DataFrame:
    """Features on the curve: usable sales are laid out with their dimensions, and the features are derived where they lie."""
    star = marts.keyed(marts.effective_star(marts.usable_sales(t.dated_sales), t.dim_customer, t.dim_product))
    return unstamped(published(
        star, "features", cluster_by=marts.CLUSTER_KEYS, keys_from=marts.cluster_keys(t.dated_sales),
        then=lambda laid: marts.laid_features(laid, t.calendar, RUN_TS),
    ))


# --- load times, lineage and descriptions ----------------------------------------------------------------------------


def as_of(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def load_stamps(t: Tables) -> DataFrame:
    """When the rows of every dataset were loaded, by the stamp that it carries."""
    datasets = {f"silver.{name}": t.silver(name) for name in FEEDS}
    datasets |= {"gold.dim_customer": t.dim_customer, "gold.dim_product": t.dim_product, "gold.dim_calendar": t.calendar,
                 "gold.fact_sales_effective": t.effective_fact, "gold.fact_sales_ml": t.features}
    datasets |= {f"classic.{name}": plan(t.with_lineage(source), RUN_TS) for name, (source, plan) in classic.TABLES.items()}

    def stamps(name: str, df: DataFrame) -> DataFrame:
        own = [c for c in [*STAMPS, "bronze_load_timestamp"] if c in df.columns]
        counts = df.groupBy(*own).agg(F.count(F.lit(1)).alias("records"))
        each = F.array(*[F.struct(F.lit(c).alias("stamp"), as_of(c).alias("loaded_at")) for c in own])
        return counts.select(F.lit(name).alias("table_name"), F.inline(each), "records")

    return profile.union([stamps(*dataset) for dataset in datasets.items()])


def file_lineage(t: Tables) -> DataFrame:
    """The folder that the rows of each ingested feed came from, and when."""
    def lineage(name: str) -> DataFrame:
        rows = with_lineage(read_feed(t.spark, t.as_csv(name), FEEDS[name]), RUN_TS)
        files = rows.groupBy("file_name", "ingest_datetime").agg(F.count(F.lit(1)).alias("records"))  # names are parsed once a file
        folder = F.regexp_extract("file_name", r"([^/]+)/[^/]+\.csv$", 1)
        return files.groupBy(folder.alias("folder"), as_of("ingest_datetime").alias("ingested_at")).agg(
            F.sum("records").alias("records")).select(F.lit(name).alias("table_name"), "folder", "ingested_at", "records")

    return profile.union([lineage(name) for name in FEEDS])


PLANS: dict[str, Callable[[Tables], DataFrame]] = {
    **{f"ingest_csv_{name}": partial(ingest_csv, name) for name in FEEDS},
    "ingest_corrupt_rows": ingest_corrupt_rows,
    "ingest_merged_schema": ingest_merged_schema,
    "peek_raw": peek_raw,
    **{f"refined_{name}": partial(refined_table, name) for name in FEEDS},
    "dedup_best_record": dedup_best_record,
    "version_intervals": intervals,
    "date_guards": date_guards,
    **{f"rules_{name}": partial(rule_report, name) for name in FEEDS},
    "dim_customer": lambda t: unstamped(t.dim_customer),
    "dim_product": lambda t: unstamped(t.dim_product),
    "dim_calendar": lambda t: unstamped(calendar_of_sales(t)),
    "fact_sales": lambda t: unstamped(t.fact),
    "fact_sales_effective": lambda t: unstamped(t.effective_fact),
    "fact_sales_ml": lambda t: unstamped(marts.fact_sales_ml(t.dated_fact, RUN_TS)),
    "kpi_total_sales": lambda t: metrics.total_sales(t.measures),
    "kpi_total_items": lambda t: metrics.total_items(t.measures),
    "kpi_avg_price": lambda t: metrics.avg_price(t.measures),
    "kpi_orders": lambda t: metrics.total_orders(t.sales),
    "kpi_products": lambda t: metrics.total_products(t.dim_product),
    "kpi_customers": lambda t: metrics.total_customers(t.dim_customer),
    "kpi_buyers": lambda t: metrics.total_buyers(t.dim_customer, t.sales),
    "order_span": lambda t: metrics.order_span(t.sales),
    "customer_age_span": lambda t: metrics.customer_age_span(t.dim_customer, RUN_TS),
    "countries": lambda t: metrics.countries(t.dim_customer),
    "product_hierarchy": lambda t: metrics.product_hierarchy(t.dim_product),
    "business_report": lambda t: metrics.business_report(t.measures, t.dim_customer, t.dim_product, t.sales),
    **{f"classic_{name}": partial(classic_table, name) for name in classic.TABLES},
    "table_counts": lambda t: profile.table_counts({name: t.raw(name) for name in FEEDS}),
    "table_profile": lambda t: profile.table_profile({name: t.raw(name) for name in FEEDS}),
    "relationship_check": relationships,
    "publish_roundtrip": publish_roundtrip,
    "clustered_roundtrip": clustered_roundtrip,
    "load_stamps": load_stamps,
    "file_lineage": file_lineage,
    "top_products": lambda t: questions.top_products(t.dated_sales, t.dim_product),
    "top_customers": lambda t: questions.top_customers(t.sales, t.dim_customer),
    "monthly_growth": lambda t: questions.monthly_growth(t.dated_sales),
    "weak_regions": lambda t: questions.weak_regions(t.sales, t.dim_customer),
    "spend_drivers": lambda t: questions.spend_drivers(t.sales, t.dim_customer),
    "spend_correlation": lambda t: questions.spend_correlation(t.sales, t.dim_customer),
    "category_margin": lambda t: questions.category_margin(t.dated_sales, t.dim_product),
    "ship_delay": lambda t: questions.ship_delay(t.dated_sales, t.dim_product),
    "sales_trend": lambda t: questions.sales_trend(t.dated_sales),
    "sales_forecast": lambda t: predictions.sales_forecast(t.dated_sales),
    "demand_forecast": lambda t: predictions.demand_forecast(t.dated_sales, t.dim_product),
    "customer_segments": lambda t: predictions.customer_segments(t.dated_sales, RUN_TS),
    "segments_kmeans": lambda t: forecasts.segments(t.dated_sales, RUN_TS),
    "sales_regression": lambda t: forecasts.sales_regression(t.features),
    "sales_prediction": lambda t: forecasts.sales_prediction(t.features),
    "regression_quality": lambda t: forecasts.regression_quality(t.features),
    "seasonal_forecast": lambda t: forecasts.seasonal_forecast(t.dated_sales, t.dim_product),
    "sales_forecast_quality": lambda t: forecasts.forecast_quality(t.dated_sales),
    "demand_forecast_quality": lambda t: forecasts.demand_forecast_quality(t.dated_sales, t.dim_product),
    "spend_tree": lambda t: forecasts.spend_tree(t.sales, t.dim_customer),
    "delivery_shifts": lambda t: forecasts.delivery_shifts(t.dated_sales, t.dim_product),
    "suggestions": lambda t: forecasts.suggestions(t.sales, t.dim_customer),
    "factor_losses": lambda t: forecasts.factor_losses(t.sales),
    "recommendations": lambda t: predictions.recommendations(t.sales, t.dim_customer),
}


def queries() -> dict[str, Query]:
    def bound(plan: Callable[[Tables], DataFrame]) -> Query:
        return lambda spark, sf_dir: plan(Tables(spark, sf_dir))

    return {name: bound(plan) for name, plan in PLANS.items()}
