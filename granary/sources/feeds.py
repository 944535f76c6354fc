"""The six raw feeds, derived from the test tables by fixed remainder rules (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(number: Column, values: list[str | None]) -> Column:
    """The value at the position given by the remainder of a number."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (number % len(values) + 1).cast("int"))


def padded(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def half(number: Column) -> Column:
    return F.floor(number / 2)


def yyyymmdd(moment: Column) -> Column:
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def days_after(first: str, days: Column) -> Column:
    return F.date_add(F.lit(first).cast("date"), days.cast("int"))


def crm_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select(k)
    key = F.concat(F.lit("AW"), padded(k, 8))
    first_entries = customers.select(
        F.when(k % 61 != 60, k).alias("cst_id"),
        key.alias("cst_key"),
        pick(k, ["  ann  marie ", "JON", None, "   ", "o'neil", " eva-lyn", "rob"]).alias("cst_firstname"),
        pick(k, [" yang", "de  la  cruz", "", "SMITH", None]).alias("cst_lastname"),
        pick(k, ["M", " S ", None, "", "divorced", "S"]).alias("cst_marital_status"),
        pick(k, ["F", " M", None, "m"]).alias("cst_gndr"),
        days_after("2020-01-01", k % 1000).alias("cst_create_date"),
    )
    late_entries = customers.where(k % 10 == 3).select(
        k.alias("cst_id"),
        key.alias("cst_key"),
        F.lit("late").alias("cst_firstname"),
        F.lit("entry").alias("cst_lastname"),
        F.lit(None).cast("string").alias("cst_marital_status"),
        F.when(k % 20 == 3, F.lit("F")).alias("cst_gndr"),
        days_after("2023-01-01", k % 300).alias("cst_create_date"),
    )
    return first_entries.unionByName(late_entries)


def crm_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    b = half(p)
    dashed = F.concat(F.lit(" "), "p_name", F.lit("--"), "p_brand", F.lit("  x"))
    parts = table(spark, sf_dir, "part")
    key = F.concat(F.lit("C"), b % 6, F.lit("-S"), b % 4, F.lit("-P-"), padded(b, 6))
    columns = [
        F.when(p % 17 == 0, None).when(p % 5 == 0, dashed).otherwise(F.col("p_name")).alias("prd_nm"),
        F.when(p % 13 != 0, half(F.col("p_retailprice")).cast("int")).alias("prd_cost"),
        pick(F.col("p_size"), ["M", "R ", "S", "T", None, " ", "Z"]).alias("prd_line"),
        days_after("1994-01-01", p % 2 * 1500).alias("prd_start_dt"),
        F.lit(None).cast("date").alias("prd_end_dt"),
    ]
    usual = parts.select(p.alias("prd_id"), key.alias("prd_key"), *columns)
    # keys of another category with the same remainder, and very long keys
    other = parts.where(p % 40 == 1).select((p + 10_000_000).alias("prd_id"), F.concat(F.lit("D"), F.substr(key, F.lit(2))).alias("prd_key"), *columns)
    long = parts.where(p % 100 == 0).select((p + 20_000_000).alias("prd_id"), F.concat(key, F.repeat(F.lit("-x"), F.lit(75))).alias("prd_key"), *columns)
    return usual.unionByName(other).unionByName(long)


def crm_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_of(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def dealt_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales feed with its lines dealt out to all tasks first."""
    columns = ["l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    return sales_of(table(spark, sf_dir, "lineitem").select(*columns).repartition("l_orderkey"), table(spark, sf_dir, "orders"))


def sales_of(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    o, part = F.col("l_orderkey"), F.col("l_partkey")
    ordered, shipped = F.col("o_orderdate"), F.col("l_shipdate")
    amount, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    columns = ["l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_shipdate"]
    lines = lineitem.select(*columns).join(
        orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return lines.select(
        F.when(o % 997 != 0, F.concat(F.lit("SO"), o)).alias("sls_ord_num"),
        F.when(part % 307 == 0, F.lit(" ")).otherwise(F.concat(F.lit("P-"), padded(half(part), 6))).alias("sls_prd_key"),
        F.col("o_custkey").alias("sls_cust_id"),
        F.when((o % 211 == 0) | (F.trunc(ordered, "month") == F.lit("1997-03-01").cast("date")), 0)
        .when(o % 223 == 0, 32154).otherwise(yyyymmdd(ordered)).alias("sls_order_dt"),
        yyyymmdd(shipped).alias("sls_ship_dt"),
        F.when(o % 5 == 0, F.year(ordered) * 10000 + F.month(ordered) * 100 + 28)
        .otherwise((F.year(shipped) + 1) * 10000 + F.month(shipped) * 100 + 1)
        .alias("sls_due_dt"),
        F.when(o % 89 == 0, None).when(o % 97 == 0, -1).otherwise(F.floor(amount).cast("int")).alias("sls_sales"),
        F.when(o % 101 == 0, -2).otherwise(F.floor(quantity).cast("int")).alias("sls_quantity"),
        F.when(o % 103 == 0, None).when(o % 107 == 0, -5)
        .otherwise(F.floor(amount / quantity).cast("int")).alias("sls_price"),
    )


def erp_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    prefix = F.when(k % 2 == 0, F.lit("NAS")).otherwise(F.lit(""))
    matching = F.when(k % 31 == 7, F.lit("zz")).otherwise(F.lit("aw"))
    key = F.concat(prefix, matching, padded(k, 8), F.lit(" ")).alias("CID")
    customers = table(spark, sf_dir, "customer")
    first_entries = customers.select(
        key,
        F.when(k % 29 != 0, days_after("1930-01-01", k * 37 % 40000)).alias("BDATE"),
        pick(k, ["M", " female ", "Male", "F", None, "", "X", "FEMALE"]).alias("GEN"),
    )
    repeated = customers.where(k % 50 == 1).select(key, days_after("1960-01-01", k % 9000).alias("BDATE"), F.lit("M").alias("GEN"))
    return first_entries.unionByName(repeated)


def erp_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    countries = ["US", "USA", "united  states", "DE", "Germany", " Australia", "UNITED KINGDOM", "", None, "Canada",
                 "Japan", "france"]
    matching = F.when(k % 37 == 5, F.lit("ZZ-")).otherwise(F.lit("AW-"))
    return table(spark, sf_dir, "customer").select(
        F.concat(matching, padded(k, 8)).alias("CID"),
        pick(F.col("c_nationkey"), countries).alias("CNTRY"),
    )


def erp_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("n_nationkey")
    r, n = nation % 6, F.floor(nation / 6)
    matching = F.when((r == 5) & (n == 3), F.lit(" x")).otherwise(F.lit(" c"))
    return table(spark, sf_dir, "nation").select(
        F.concat(matching, r, F.lit("_s"), n).alias("ID"),
        pick(r, ["bikes", " ACCESSORIES", None, "spare  parts"]).alias("CAT"),
        pick(n, ["road frames", "", "Helmets", "socks"]).alias("SUBCAT"),
        pick(r + n, ["Yes", "No", " yes", None]).alias("MAINTENANCE"),
    )


FEEDS = {
    "crm_customer": crm_customer,
    "crm_product": crm_product,
    "crm_sales": crm_sales,
    "erp_category": erp_category,
    "erp_customer": erp_customer,
    "erp_location": erp_location,
}


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw feed by name."""
    return FEEDS[name](spark, sf_dir)
