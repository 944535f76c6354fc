"""Full refresh of all layers: raw, refined, marts. Each table is written, then read back by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from granary.plans import classic, marts, refined
from granary.session import tuned
from granary.sinks.publish import publish
from granary.sources.csv import read_merged
from granary.sources.schemas import FEEDS

COMMENTS = {
    "dim_customer": "Customers with ERP demographics and location",
    "dim_product": "Product versions with category hierarchy",
    "dim_calendar": "Days with their parts and labels",
    "fact_sales": "Sales with customer, product and calendar attributes",
    "fact_sales_effective": "Sales with the product version in force at the order date",
    "fact_sales_ml": "Usable sales with derived features",
}
# Fixed values.
FEATURE_PROPERTIES = {
    "quality": "gold",
    "layer": "ml_features",
    "filters_applied": "price > 0 AND sales_amount > 0 AND quantity > 0 AND order_date IS NOT NULL",
    "use_case": "machine_learning",
}


class Lakehouse:
    """Where tables live and when the run takes place."""

    def __init__(self, spark: SparkSession, run_ts: dt.datetime, location: str | None = None, prefix: str = ""):
        self.spark = tuned(spark)
        self.run_ts = run_ts
        self.location = location
        self.prefix = prefix
        self.audit: dict[str, dict[str, int]] = {}

    def name(self, layer: str, table: str) -> str:
        return f"{self.prefix}{layer}.{table}"

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.read.table(self.name(layer, table))

    def write(self, df: DataFrame, layer: str, table: str, **options) -> None:
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{layer}")
        path = f"{self.location}/{layer}/{table}" if self.location else None
        properties = options.pop("properties", {"quality": layer, "layer": layer})
        self.audit[self.name(layer, table)] = publish(
            df, self.name(layer, table), properties=properties, path=path, **options
        )

    def ingest(self, paths: Mapping[str, str]) -> None:
        """Raw layer: every feed as it arrived, whatever the order of its columns, with lineage and corrupt lines."""
        for feed, schema in FEEDS.items():
            rows = read_merged(self.spark, [paths[feed]], schema, self.run_ts)
            properties = {"quality": "bronze", "layer": "bronze", "source_format": "csv"}
            self.write(rows, "bronze", feed, comment=f"Raw {feed} feed", properties=properties)

    def refine(self) -> None:
        """Refined layer: cleaned feeds; rule violations go to the audit."""
        for feed, clean in refined.CLEANERS.items():
            cleaned = clean(self.read("bronze", feed), self.run_ts)
            self.write(
                cleaned, "silver", feed, rules=refined.rules(feed, self.run_ts), comment=f"Cleaned {feed} records"
            )

    def refine_classic(self) -> None:
        """The earlier cleaning variant, next to the refined layer."""
        for table, (feed, plan) in classic.TABLES.items():
            self.write(plan(self.read("bronze", feed), self.run_ts), "silver", table)

    def build_marts(self, first_day: dt.date, last_day: dt.date) -> None:
        """Star schema and feature table."""
        silver = {feed: self.read("silver", feed) for feed in FEEDS}

        def mart(table: str, df: DataFrame, **options) -> DataFrame:
            self.write(df, "gold", table, comment=COMMENTS[table], **options)
            return self.read("gold", table)

        customers = mart("dim_customer", marts.dim_customer(
            silver["crm_customer"], silver["erp_customer"], silver["erp_location"], self.run_ts
        ))
        products = mart("dim_product", marts.dim_product(silver["crm_product"], silver["erp_category"], self.run_ts))
        bounds = marts.fixed_bounds(self.spark, first_day, last_day)
        calendar = mart("dim_calendar", marts.dim_calendar(bounds, self.run_ts))
        star = (silver["crm_sales"], customers, products, calendar, self.run_ts)
        fact = mart("fact_sales", marts.fact_sales(*star))
        mart("fact_sales_effective", marts.fact_sales_effective(*star))
        mart("fact_sales_ml", marts.fact_sales_ml(fact, self.run_ts),
             cluster_by=marts.CLUSTER_KEYS, keys_from=marts.cluster_keys(silver["crm_sales"]), properties=FEATURE_PROPERTIES)
