"""Refined layer: one cleaned dataset per raw feed.

Each ``clean_*`` function maps raw rows to cleaned rows before rules; ``RULES`` holds the rules of each dataset and
``refined`` applies both. ``ingest_timestamp`` is the run time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import codes, dates, numbers, text
from granary.operators.dedup import best_record
from granary.operators.rules import DROP, Rule, enforce
from granary.operators.versions import version_intervals

COMPLETENESS = ["first_name", "last_name", "marital_status", "gender"]


def loaded_at(run_ts: dt.datetime) -> Column:
    return dates.moment(run_ts).alias("ingest_timestamp")


def standardised_customers(raw: DataFrame) -> DataFrame:
    """Customer records with clean texts and expanded codes, duplicates included."""
    texts = ["cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr"]
    titled = raw.withColumns({f"{name}_title": text.title(F.col(name)) for name in texts})
    return titled.select(
        F.col("cst_id").alias("customer_id"),
        F.col("cst_key").alias("customer_key"),
        text.or_missing(F.col("cst_firstname_title")).alias("first_name"),
        text.or_missing(F.col("cst_lastname_title")).alias("last_name"),
        codes.expanded(F.col("cst_marital_status"), codes.MARITAL_STATUS, F.col("cst_marital_status_title"))
        .alias("marital_status"),
        codes.expanded(F.col("cst_gndr"), codes.CRM_GENDER, F.col("cst_gndr_title")).alias("gender"),
        F.col("cst_create_date").alias("created_date"),
    )


def best_customers(standardised: DataFrame) -> DataFrame:
    """The most complete, then most recent, record of each customer id."""
    preference = [numbers.completeness(COMPLETENESS).desc(), F.col("created_date").desc_nulls_last()]
    return best_record(standardised, "customer_id", preference)


def clean_crm_customer(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return best_customers(standardised_customers(raw)).select("*", loaded_at(run_ts))


def clean_crm_product(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Products with validity intervals per full key; the key is split into category and remainder afterwards."""
    versions = version_intervals(raw.select(*PRODUCT_COLUMNS), "prd_key", "prd_start_dt", "prd_end_dt")
    squeezed = versions.withColumns({
        "category": text.key_category(F.col("prd_key")),
        "remainder": text.key_remainder(F.col("prd_key")),
        "line": text.squeeze(F.col("prd_line")),
    })
    return squeezed.select(
        F.col("prd_id").alias("product_id"),
        text.or_missing(F.col("category")).alias("product_category"),
        text.or_missing(F.col("remainder")).alias("product_key"),
        text.undashed_name(F.col("prd_nm")).alias("product_name"),
        F.coalesce("prd_cost", F.lit(0)).alias("product_cost"),
        codes.expanded(F.col("prd_line"), codes.PRODUCT_LINE, F.col("line")).alias("product_line"),
        F.col("prd_start_dt").alias("product_start_date"),
        F.col("prd_end_dt").alias("product_end_date"),
        loaded_at(run_ts),
    )


PRODUCT_COLUMNS = ["prd_id", "prd_key", "prd_nm", "prd_cost", "prd_line", "prd_start_dt", "prd_end_dt"]


SALES_DAYS = {"sls_order_dt": "order_date", "sls_ship_dt": "ship_date", "sls_due_dt": "due_date"}


def guarded_dates(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Add believable dates in the sequence order, ship, due; a date that breaks the sequence is dropped.

    Due is compared with the ship date that survived, so a ship date before the order does not cost the due date.
    One step per guard, so that no date is computed twice.
    """
    order, ship, due = (F.col(name) for name in SALES_DAYS.values())
    return (
        dates.with_dates(raw, SALES_DAYS, dates.EARLIEST, run_ts.date())
        .withColumns({"ship_date": dates.not_before(ship, order), "due_date": dates.not_before(due, order)})
        .withColumn("due_date", dates.not_before(due, ship))
    )


def clean_crm_sales(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    return guarded_dates(raw, run_ts).select(
        F.col("sls_ord_num").alias("order_number"),
        text.blank_to_null(F.col("sls_prd_key")).alias("product_key"),
        F.col("sls_cust_id").alias("customer_id"),
        *SALES_DAYS.values(),
        numbers.positive_or_zero(F.col("sls_sales")).alias("sales_amount"),
        numbers.positive_or_zero(F.col("sls_quantity")).alias("quantity"),
        numbers.positive_or_zero(F.col("sls_price")).alias("price"),
        loaded_at(run_ts),
    )


def clean_erp_category(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    titled = raw.withColumns({name: text.title(F.col(name)) for name in ["CAT", "SUBCAT"]})
    return titled.select(
        text.code(F.col("ID")).alias("category_id"),
        text.or_missing(F.col("CAT")).alias("category"),
        text.or_missing(F.col("SUBCAT")).alias("subcategory"),
        codes.yes_flag(F.col("MAINTENANCE")).alias("requires_maintenance"),
        loaded_at(run_ts),
    )


def clean_erp_customer(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    born = raw.withColumn("BDATE", dates.not_future(F.col("BDATE"), run_ts))
    aged = born.withColumn("age", dates.whole_years(F.col("BDATE"), run_ts))
    return aged.select(
        text.without_prefix(F.col("CID"), "NAS").alias("customer_id"),
        F.col("BDATE").alias("birth_date"),
        codes.decoded(F.upper(text.trimmed(F.col("GEN"))), codes.ERP_GENDER, F.lit(text.MISSING)).alias("gender"),
        "age",
        codes.age_group(F.col("age")).alias("age_group"),
        loaded_at(run_ts),
    )


def clean_erp_location(raw: DataFrame, run_ts: dt.datetime, aliases: Mapping[str, str] = codes.COUNTRY_ALIASES,
                       regions: Mapping[str, Sequence[str]] = codes.REGIONS) -> DataFrame:
    """Locations with one name per country and its region; both tables are parameters."""
    titled = raw.withColumn("name", text.title(F.col("CNTRY")))
    known = titled.withColumn("country", codes.decoded(F.col("name"), aliases, text.or_missing(F.col("name"))))
    return known.select(
        text.without_dashes(F.col("CID")).alias("customer_id"),
        "country",
        codes.bucket(F.col("country"), regions, F.lit(codes.OTHER_REGION)).alias("region"),
        loaded_at(run_ts),
    )


CLEANERS = {
    "crm_customer": clean_crm_customer,
    "crm_product": clean_crm_product,
    "crm_sales": clean_crm_sales,
    "erp_category": clean_erp_category,
    "erp_customer": clean_erp_customer,
    "erp_location": clean_erp_location,
}


def rules(dataset: str, run_ts: dt.datetime) -> list[Rule]:
    """The rules of a refined dataset, judged against the run date."""
    today = f"DATE'{run_ts.date()}'"
    earliest = f"DATE'{dates.EARLIEST}'"
    # Rule names, value domains and bounds.
    return {
        "crm_customer": [
            Rule("valid_customer_id", "customer_id IS NOT NULL", DROP),
            Rule("valid_gender", "gender IN ('Female', 'Male', 'N/A')"),
            Rule("valid_marital_status", "marital_status IN ('Married', 'Single', 'N/A')"),
            Rule("valid_created_date", f"created_date <= {today}"),
            Rule("complete_names", "first_name <> 'N/A' AND last_name <> 'N/A'"),
        ],
        "crm_product": [
            Rule("valid_product_id", "product_id IS NOT NULL", DROP),
            Rule("valid_product_key", "product_key IS NOT NULL"),
            Rule("valid_product_name", "product_name IS NOT NULL"),
            Rule("valid_product_cost", "product_cost >= 0"),
            Rule(
                "valid_product_dates",
                "product_start_date IS NOT NULL AND (product_end_date IS NULL OR product_start_date <= product_end_date)",
            ),
            Rule("valid_product_line", "product_line IN ('Mountain', 'Road', 'Touring', 'Other Sales', 'N/A')"),
        ],
        "crm_sales": [
            Rule("valid_order_number", "order_number IS NOT NULL", DROP),
            Rule("valid_quantity", "quantity >= 0"),
            Rule("valid_sales_amount", "sales_amount >= 0"),
            Rule("valid_price", "price >= 0"),
            Rule("valid_order_date", f"order_date IS NULL OR order_date BETWEEN {earliest} AND {today}"),
            Rule("valid_ship_sequence", "ship_date IS NULL OR order_date IS NULL OR ship_date >= order_date"),
            Rule("valid_due_sequence", "due_date IS NULL OR order_date IS NULL OR due_date >= order_date"),
        ],
        "erp_category": [
            Rule("valid_category_id", "category_id IS NOT NULL", DROP),
            Rule("valid_category", "category IS NOT NULL"),
            Rule("valid_subcategory", "subcategory IS NOT NULL"),
            Rule("valid_maintenance_flag", "requires_maintenance IS NOT NULL"),
        ],
        "erp_customer": [
            Rule("valid_customer_id", "customer_id IS NOT NULL", DROP),
            Rule("valid_gender", "gender IN ('Male', 'Female', 'N/A')"),
            Rule("valid_birth_date", f"birth_date IS NULL OR birth_date <= {today}"),
            Rule("valid_age", "age IS NULL OR age BETWEEN 0 AND 120"),
            Rule(
                "valid_age_group",
                "age_group IN ('Unknown', 'Under 25', '25-34', '35-44', '45-54', '55-64', '65+')",
            ),
        ],
        "erp_location": [
            Rule("valid_customer_id", "customer_id IS NOT NULL", DROP),
            Rule("valid_country", "country IS NOT NULL"),
            Rule("valid_region", "region IN ('Oceania', 'North America', 'Europe', 'Unknown', 'Other')"),
        ],
    }[dataset]


def refined(dataset: str, raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """A raw feed cleaned, with its drop rules applied."""
    return enforce(CLEANERS[dataset](raw, run_ts), rules(dataset, run_ts))
