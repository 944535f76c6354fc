"""Dataset plans: invariants and the semantics that hand-written rows show best."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.functions import text
from granary.plans import marts, metrics, predictions, profile, questions, refined
from granary.queries import CALENDAR, Tables, unstamped
from granary.sources import schemas

DAY = dt.date


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return Tables(spark, sf_dir)


def raw(spark, feed, rows):
    return spark.createDataFrame(rows, schemas.FEEDS[feed])


def test_widths(tables):
    widths = {"crm_customer": 8, "crm_product": 9, "crm_sales": 10, "erp_category": 5, "erp_customer": 6,
              "erp_location": 4}
    assert {name: len(tables.silver(name).columns) for name in widths} == widths
    assert len(tables.dim_customer.columns) == 13
    assert len(tables.dim_product.columns) == 12
    assert len(tables.calendar.columns) == 16
    assert len(tables.fact.columns) == 37
    assert len(marts.fact_sales_ml(tables.fact, dt.datetime(2025, 1, 1)).columns) == 48


def test_null_customer_ids_collapse_before_they_are_dropped(spark, run_ts):  # S-4
    rows = [(None, f"k{i}", "a", "b", "M", "F", DAY(2024, 1, 1)) for i in range(3)]
    cleaned = refined.clean_crm_customer(raw(spark, "crm_customer", rows), run_ts)
    assert cleaned.count() == 1
    assert refined.refined("crm_customer", raw(spark, "crm_customer", rows), run_ts).count() == 0


def test_date_sequence(spark, run_ts):  # S-11
    rows = [
        ("ship before order keeps due", 20240110, 20240101, 20240120),
        ("due before order", 20240110, 20240112, 20240105),
        ("due before ship", 20240110, 20240120, 20240115),
        ("order unknown", 0, 20240120, 20240130),
        ("order unknown, due before ship", 0, 20240120, 20240110),
        ("too old", 19891231, 20240120, 20240130),
        ("future", 20240110, 20250102, 20240130),
    ]
    sales = [(name, "p", 1, order, ship, due, 1, 1, 1) for name, order, ship, due in rows]
    cleaned = refined.clean_crm_sales(raw(spark, "crm_sales", sales), run_ts)
    got = {r["order_number"]: (r["order_date"], r["ship_date"], r["due_date"]) for r in cleaned.collect()}
    assert got == {
        "ship before order keeps due": (DAY(2024, 1, 10), None, DAY(2024, 1, 20)),
        "due before order": (DAY(2024, 1, 10), DAY(2024, 1, 12), None),
        "due before ship": (DAY(2024, 1, 10), DAY(2024, 1, 20), None),
        "order unknown": (None, DAY(2024, 1, 20), DAY(2024, 1, 30)),
        "order unknown, due before ship": (None, DAY(2024, 1, 20), None),
        "too old": (None, DAY(2024, 1, 20), DAY(2024, 1, 30)),
        "future": (DAY(2024, 1, 10), None, DAY(2024, 1, 30)),
    }


def test_sales_dates_always_in_sequence(tables):
    broken = "ship_date < order_date OR due_date < order_date OR due_date < ship_date"
    assert tables.sales.where(broken).count() == 0


def test_drop_rules_leave_no_violation(tables, run_ts):
    for name in schemas.FEEDS:
        for rule in refined.rules(name, run_ts):
            if rule.action == "drop":
                assert tables.silver(name).where(~rule.met).count() == 0


def test_erp_gender_wins_even_when_missing(spark, run_ts):  # S-6, S-18
    customers = refined.clean_crm_customer(raw(spark, "crm_customer", [
        (1, "AW1", "a", "b", "M", "F", DAY(2024, 1, 1)), (2, "AW2", "a", "b", "M", "F", DAY(2024, 1, 1)),
    ]), run_ts)
    people = refined.clean_erp_customer(raw(spark, "erp_customer", [
        ("NASAW1", DAY(1890, 1, 1), None), ("AW1", None, "M"), (None, None, "M"),
    ]), run_ts)
    locations = refined.clean_erp_location(raw(spark, "erp_location", [("AW-1", "US")]), run_ts)
    dim = marts.dim_customer(customers, people, locations, run_ts)
    got = sorted((r["customer_id"], r["gender"], r["age_group"], r["region"] or "") for r in dim.collect())
    assert got == [
        (1, "Male", "Unknown", "North America"), (1, "N/A", "65+", "North America"), (2, "Female", None, "")
    ]
    assert refined.refined("erp_customer", people.select(
        F.col("customer_id").alias("CID"), F.col("birth_date").alias("BDATE"), F.col("gender").alias("GEN")
    ), run_ts).count() == 2


def test_fact_rows_follow_versions_and_effective_rows_follow_sales(tables):  # S-1, S-15
    versions = tables.dim_product.groupBy("product_key").agg(F.count(F.lit(1)).alias("n"))
    people = tables.dim_customer.groupBy("customer_id").agg(F.count(F.lit(1)).alias("m"))
    rows = F.coalesce("n", F.lit(1)) * F.coalesce("m", F.lit(1))
    expected = tables.sales.join(versions, "product_key", "left").join(people, "customer_id", "left").agg(F.sum(rows)).first()[0]
    assert tables.fact.count() == expected
    effective = tables.effective_fact
    assert effective.count() == tables.sales.count()
    outside = effective.where(~F.col("order_date").between(*CALENDAR))
    assert outside.count() > 0 and outside.where(F.col("order_year").isNotNull()).count() == 0


def test_a_lookup_is_planned_without_a_job(spark, tables):
    sales, customers = tables.sales, tables.dim_customer
    spark.sparkContext.setJobGroup("lookup", "planning")
    marts.with_customer(sales, customers)
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("lookup")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not started


def sales_of(spark, rows):
    columns = "order_number string, customer_id bigint, product_key string, order_date date, ship_date date, due_date date, sales_amount int, quantity int, price int"
    return spark.createDataFrame([(f"SO{i}", c, p, day, None, None, amount, 1, amount) for i, (c, p, day, amount) in enumerate(rows)], columns)


def test_colliding_prefixes_give_one_version_a_day(spark):
    products = spark.createDataFrame(
        [(1, "P", DAY(2020, 1, 1), DAY(2020, 5, 31)), (2, "P", DAY(2020, 6, 1), None), (3, "P", DAY(2020, 3, 1), None), (4, "P", DAY(2020, 1, 1), None)],
        "product_id bigint, product_key string, product_start_date date, product_end_date date")
    whole = products.select("*", *(F.lit(None).cast("string").alias(c) for c in marts.PRODUCT if c not in products.columns))
    days = [DAY(2019, 1, 1), DAY(2020, 2, 1), DAY(2020, 4, 1), DAY(2020, 7, 1), None]
    sales = sales_of(spark, [(1, "P", day, 10) for day in days])
    found = {r.order_date: r.product_id for r in marts.with_version_in_force(sales, whole).collect()}
    assert found == dict(zip(days, [None, 4, 3, 2, None]))


def test_repeated_customers_count_once(spark):
    customers = spark.createDataFrame([(1, "AW1", "Europe"), (1, "AW1", "Oceania"), (2, "AW2", "Europe")], "customer_id bigint, customer_key string, region string")
    whole = customers.select("*", *(F.lit(None).cast("string").alias(c) for c in [*marts.CUSTOMER] if c not in customers.columns))
    sales = sales_of(spark, [(1, "P", DAY(2020, 1, 1), 10), (2, "P", DAY(2020, 1, 1), 5)])
    assert [(r.region, r.total_sales) for r in questions.weak_regions(sales, whole).collect()] == [("Europe", 15)]
    assert len(questions.top_customers(sales, whole, limit=1).collect()) == 1


def test_months_without_sales_count_as_zero(spark):
    sales = sales_of(spark, [(1, "P", DAY(2020, 1, 5), 10), (1, "P", DAY(2020, 4, 5), 20)])
    growth = {r.month.month: (r.total_sales, r.previous_sales, r.growth_pct) for r in questions.monthly_growth(sales).collect()}
    assert growth == {1: (10, None, None), 2: (0, 10, -100.0), 3: (0, 0, None), 4: (20, 0, None)}
    assert [r.moving_average for r in questions.sales_trend(sales).orderBy("month").collect()] == [10.0, 5.0, 3.33, 6.67]


def test_recommendations_look_up_the_regions_once(spark, tmp_path):
    people = [(1, "Europe"), (2, "Europe"), (3, None), (4, "Asia")]
    customer = {c: F.lit(None).cast("string") for c in marts.CUSTOMER if c != "region"}
    spark.createDataFrame(people, "customer_id long, region string").withColumns(customer).write.parquet(str(tmp_path / "customers"))
    sales = spark.createDataFrame([(1, "a", 5), (1, "b", 1), (2, "c", 3), (3, "a", 9), (7, "a", 9)], "customer_id long, product_key string, quantity int")
    found = predictions.recommendations(sales, spark.read.parquet(str(tmp_path / "customers")))
    assert not any(str(tmp_path / "customers") in file for file in found.inputFiles())
    assert sorted(map(tuple, found.collect())) == [(1, "c", 2), (2, "a", 1), (3, None, None), (4, None, None)]


def test_suggestions_reach_every_customer(spark):
    products = [f"P{i:02}" for i in range(13)]
    rows = [(c, p, DAY(2020, 1, 1), 1) for c, left_out in ((1, "P12"), (2, "P11")) for p in products if p != left_out]
    rows += [(3, p, DAY(2020, 1, 1), 1) for p in products]
    customers = spark.createDataFrame([(c, f"AW{c}", "Europe" if c < 4 else None) for c in (1, 2, 3, 4)] + [(5, "AW5", "Europe")], "customer_id bigint, customer_key string, region string")
    whole = customers.select("*", *(F.lit(None).cast("string").alias(c) for c in [*marts.CUSTOMER] if c not in customers.columns))
    found = {r.customer_id: r.product_key for r in predictions.recommendations(sales_of(spark, rows), whole).collect()}
    assert found == {1: "P12", 2: "P11", 3: None, 4: None, 5: "P00"}


def test_long_product_keys_stay_whole(spark):
    key = "AB-CD-" + "x" * 150
    row = spark.createDataFrame([(key,)], "k string").select(text.key_remainder(F.col("k")).alias("r")).first()
    assert row.r == "x" * 150


def test_weighted_measures_equal_measures_of_the_fact(tables):
    of_fact, weighted = metrics.measures_of(tables.fact), tables.measures
    for metric in (metrics.total_sales, metrics.total_items, metrics.avg_price, metrics.total_orders):
        assert metric(of_fact).first() == metric(weighted).first()


def test_feature_flags(tables, run_ts):  # S-12, S-13
    features = marts.fact_sales_ml(tables.fact, run_ts)
    assert features.where("ship_date IS NULL AND is_late_shipment = 0").count() == 0
    assert features.where("ship_date IS NOT NULL AND due_date IS NOT NULL AND is_late_shipment = 1").count() == 0
    assert features.where("missing_product_cost <> if(coalesce(product_cost, 0) = 0, 1, 0)").count() == 0


def test_only_needed_columns_are_read_from_the_source(tables, capsys):
    questions.monthly_growth(tables.sales).explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan
    assert not any("o_custkey" in line for line in plan.splitlines() if line.startswith("ReadSchema"))


def test_facts_read_dimensions_that_are_written_once(tables):
    for fact in (tables.fact, tables.dated_fact):
        sources = [file.rsplit("/", 1)[-1] for file in fact.inputFiles()]
        assert sources and not {"customer.parquet", "part.parquet", "nation.parquet"} & set(sources)


def test_no_cartesian_products(tables, capsys):
    for df in (tables.fact, tables.effective_fact, tables.measures, unstamped(tables.dim_customer)):
        df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_spanned_years(spark):
    days = spark.createDataFrame([(DAY(2023, 5, 6),), (DAY(2024, 2, 3),), (None,)], "d date")
    assert tuple(marts.spanned_years(days, "d").first()) == (DAY(2023, 1, 1), DAY(2024, 12, 31))


def test_order_span_counts_complete_years(spark):  # S-17
    sales = spark.createDataFrame([(DAY(2010, 12, 31),), (DAY(2011, 1, 1),)], "order_date date")
    assert metrics.order_span(sales).first()["order_range_years"] == 0


def test_relationship_check_counts_rows_not_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    got = profile.relationship_check({"link": (child, "k", parent, "k")}).collect()
    assert [tuple(row) for row in got] == [("link", 5, 3)]
