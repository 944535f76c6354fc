"""DuckDB counterparts of the registered queries, written independently of the Spark plans.

Shared steps are named subqueries; each statement carries only the ones it needs. Every statement runs over whole tables.
"""

from __future__ import annotations

import re

from granary import oracle_models

TODAY = "DATE '2025-01-01'"


# --- fragments -------------------------------------------------------------------------------------------------------


def squeeze(c: str) -> str:
    return rf"regexp_replace(trim(coalesce({c}, '')), '\s+', ' ', 'g')"


def title(c: str) -> str:
    words = f"string_split({squeeze(c)}, ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || lower(w[2:])), ' ')"


def or_na(expr: str) -> str:
    return f"CASE WHEN {expr} = '' THEN 'N/A' ELSE {expr} END"


def to_date(c: str) -> str:
    return f"CAST(try_strptime(CAST({c} AS VARCHAR), '%Y%m%d') AS DATE)"


def guard(c: str) -> str:
    return f"CASE WHEN {c} >= DATE '1990-01-01' AND {c} <= {TODAY} THEN {c} END"


def zero(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR {c} < 0 THEN 0 ELSE {c} END"


def r2(expr: str) -> str:
    """Half-up rounding of the shortest decimal form of a double."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def pick(number: str, values: list[str | None]) -> str:
    cases = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(values))
    return f"CASE {number} % {len(values)} {cases} END"


def literal(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else "'" + value.replace("'", "''") + "'"


def yyyymmdd(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


def days_after(first: str, days: str) -> str:
    return f"DATE '{first}' + CAST({days} AS INTEGER)"


# --- raw feeds -------------------------------------------------------------------------------------------------------

K = "'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')"
FIRST = pick("c_custkey", ["  ann  marie ", "JON", None, "   ", "o'neil", " eva-lyn", "rob"])
LAST = pick("c_custkey", [" yang", "de  la  cruz", "", "SMITH", None])
MARITAL = pick("c_custkey", ["M", " S ", None, "", "divorced", "S"])
ERP_KEY = """CASE WHEN c_custkey % 2 = 0 THEN 'NAS' ELSE '' END || CASE WHEN c_custkey % 31 = 7 THEN 'zz' ELSE 'aw' END
               || lpad(CAST(c_custkey AS VARCHAR), 8, '0') || ' '"""
COUNTRIES = ["US", "USA", "united  states", "DE", "Germany", " Australia", "UNITED KINGDOM", "", None, "Canada", "Japan",
             "france"]

PARTS = {
    "raw_crm_customer": f"""
        SELECT CASE WHEN c_custkey % 61 = 60 THEN NULL ELSE c_custkey END AS cst_id, {K} AS cst_key,
               {FIRST} AS cst_firstname, {LAST} AS cst_lastname, {MARITAL} AS cst_marital_status,
               {pick("c_custkey", ["F", " M", None, "m"])} AS cst_gndr,
               {days_after("2020-01-01", "c_custkey % 1000")} AS cst_create_date
        FROM customer
        UNION ALL
        SELECT c_custkey, {K}, 'late', 'entry', NULL, CASE WHEN c_custkey % 20 = 3 THEN 'F' END,
               {days_after("2023-01-01", "c_custkey % 300")}
        FROM customer WHERE c_custkey % 10 = 3""",
    "raw_crm_product": f"""
        SELECT p_partkey + added AS prd_id,
               first || (b % 6) || '-S' || (b % 4) || '-P-' || lpad(CAST(b AS VARCHAR), 6, '0') || tail AS prd_key,
               CASE WHEN p_partkey % 17 = 0 THEN NULL
                    WHEN p_partkey % 5 = 0 THEN ' ' || p_name || '--' || p_brand || '  x' ELSE p_name END AS prd_nm,
               CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(floor(p_retailprice / 2) AS INTEGER) END AS prd_cost,
               {pick("p_size", ["M", "R ", "S", "T", None, " ", "Z"])} AS prd_line,
               {days_after("1994-01-01", "p_partkey % 2 * 1500")} AS prd_start_dt, CAST(NULL AS DATE) AS prd_end_dt
        FROM (SELECT *, p_partkey // 2 AS b, 0 AS added, 'C' AS first, '' AS tail FROM part
              UNION ALL SELECT *, p_partkey // 2, 10000000, 'D', '' FROM part WHERE p_partkey % 40 = 1
              UNION ALL SELECT *, p_partkey // 2, 20000000, 'C', repeat('-x', 75) FROM part WHERE p_partkey % 100 = 0)""",
    "raw_crm_sales": f"""
        SELECT CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE 'SO' || l_orderkey END AS sls_ord_num,
               CASE WHEN l_partkey % 307 = 0 THEN ' '
                    ELSE 'P-' || lpad(CAST(l_partkey // 2 AS VARCHAR), 6, '0') END AS sls_prd_key,
               o_custkey AS sls_cust_id,
               CASE WHEN l_orderkey % 211 = 0 OR date_trunc('month', o_orderdate) = DATE '1997-03-01' THEN 0 WHEN l_orderkey % 223 = 0 THEN 32154
                    ELSE {yyyymmdd("o_orderdate")} END AS sls_order_dt,
               {yyyymmdd("l_shipdate")} AS sls_ship_dt,
               CAST(CASE WHEN l_orderkey % 5 = 0 THEN year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 28
                    ELSE (year(l_shipdate) + 1) * 10000 + month(l_shipdate) * 100 + 1 END AS INTEGER) AS sls_due_dt,
               CASE WHEN l_orderkey % 89 = 0 THEN NULL WHEN l_orderkey % 97 = 0 THEN -1
                    ELSE CAST(floor(l_extendedprice) AS INTEGER) END AS sls_sales,
               CASE WHEN l_orderkey % 101 = 0 THEN -2 ELSE CAST(floor(l_quantity) AS INTEGER) END AS sls_quantity,
               CASE WHEN l_orderkey % 103 = 0 THEN NULL WHEN l_orderkey % 107 = 0 THEN -5
                    ELSE CAST(floor(l_extendedprice / l_quantity) AS INTEGER) END AS sls_price
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "raw_erp_customer": f"""
        SELECT {ERP_KEY} AS "CID",
               CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE {days_after("1930-01-01", "c_custkey * 37 % 40000")} END
               AS "BDATE",
               {pick("c_custkey", ["M", " female ", "Male", "F", None, "", "X", "FEMALE"])} AS "GEN"
        FROM customer
        UNION ALL
        SELECT {ERP_KEY}, {days_after("1960-01-01", "c_custkey % 9000")}, 'M' FROM customer WHERE c_custkey % 50 = 1""",
    "raw_erp_location": f"""
        SELECT CASE WHEN c_custkey % 37 = 5 THEN 'ZZ-' ELSE 'AW-' END || lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS "CID",
               {pick("c_nationkey", COUNTRIES)} AS "CNTRY"
        FROM customer""",
    "raw_erp_category": f"""
        SELECT CASE WHEN r = 5 AND n = 3 THEN ' x' ELSE ' c' END || r || '_s' || n AS "ID", {pick("r", ["bikes", " ACCESSORIES", None, "spare  parts"])} AS "CAT",
               {pick("n", ["road frames", "", "Helmets", "socks"])} AS "SUBCAT",
               {pick("(r + n)", ["Yes", "No", " yes", None])} AS "MAINTENANCE"
        FROM (SELECT n_nationkey % 6 AS r, n_nationkey // 6 AS n FROM nation)""",
    # --- refined, before rules ---
    "standard_customer": f"""
        SELECT cst_id AS customer_id, cst_key AS customer_key, {or_na(title("cst_firstname"))} AS first_name,
               {or_na(title("cst_lastname"))} AS last_name,
               CASE trim(coalesce(cst_marital_status, '')) WHEN 'M' THEN 'Married' WHEN 'S' THEN 'Single'
                    WHEN '' THEN 'N/A' ELSE {title("cst_marital_status")} END AS marital_status,
               CASE trim(coalesce(cst_gndr, '')) WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' WHEN '' THEN 'N/A'
                    ELSE {title("cst_gndr")} END AS gender,
               cst_create_date AS created_date
        FROM raw_crm_customer""",
    "clean_crm_customer": """
        SELECT * EXCLUDE (score, position) FROM (
            SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, created_date DESC NULLS LAST,
                                         customer_key) AS position
            FROM (SELECT *, CAST(first_name <> 'N/A' AS INT) + CAST(last_name <> 'N/A' AS INT)
                         + CAST(marital_status <> 'N/A' AS INT) + CAST(gender <> 'N/A' AS INT) AS score
                  FROM standard_customer))
        WHERE position = 1""",
    "product_versions": """
        SELECT prd_key, prd_id, prd_start_dt,
               lead(prd_start_dt) OVER (PARTITION BY prd_key ORDER BY prd_start_dt NULLS FIRST, prd_id) - 1 AS prd_end_dt
        FROM raw_crm_product""",
    "clean_crm_product": rf"""
        SELECT prd_id AS product_id,
               CASE WHEN trim(substr(prd_key, 1, 5)) = '' THEN 'N/A'
                    ELSE replace(trim(substr(prd_key, 1, 5)), '-', '_') END AS product_category,
               {or_na(squeeze("substr(prd_key, 7)"))} AS product_key,
               CASE WHEN {squeeze("prd_nm")} = '' THEN 'N/A'
                    ELSE regexp_replace(regexp_replace(trim(coalesce(prd_nm, '')), '[-]+', ' ', 'g'), '\s+', ' ', 'g')
               END AS product_name,
               coalesce(prd_cost, 0) AS product_cost,
               CASE trim(coalesce(prd_line, '')) WHEN 'M' THEN 'Mountain' WHEN 'R' THEN 'Road' WHEN 'T' THEN 'Touring'
                    WHEN 'S' THEN 'Other Sales' WHEN '' THEN 'N/A' ELSE {squeeze("prd_line")} END AS product_line,
               v.prd_start_dt AS product_start_date, v.prd_end_dt AS product_end_date
        FROM raw_crm_product JOIN product_versions AS v USING (prd_id, prd_key)""",
    "sales_dates": f"""
        SELECT *, CASE WHEN due1 < ship_date THEN NULL ELSE due1 END AS due_date FROM (
            SELECT *, CASE WHEN ship0 < order_date THEN NULL ELSE ship0 END AS ship_date,
                   CASE WHEN due0 < order_date THEN NULL ELSE due0 END AS due1
            FROM (SELECT *, {guard("od")} AS order_date, {guard("sd")} AS ship0, {guard("dd")} AS due0
                  FROM (SELECT *, {to_date("sls_order_dt")} AS od, {to_date("sls_ship_dt")} AS sd,
                               {to_date("sls_due_dt")} AS dd FROM raw_crm_sales)))""",
    "clean_crm_sales": f"""
        SELECT sls_ord_num AS order_number, CASE WHEN trim(sls_prd_key) = '' THEN NULL ELSE sls_prd_key END AS product_key,
               sls_cust_id AS customer_id, order_date, ship_date, due_date, {zero("sls_sales")} AS sales_amount,
               {zero("sls_quantity")} AS quantity, {zero("sls_price")} AS price
        FROM sales_dates""",
    "clean_erp_category": f"""
        SELECT upper(trim("ID")) AS category_id, {or_na(title('"CAT"'))} AS category,
               {or_na(title('"SUBCAT"'))} AS subcategory,
               upper(trim(coalesce("MAINTENANCE", ''))) = 'YES' AS requires_maintenance
        FROM raw_erp_category""",
    "clean_erp_customer": f"""
        SELECT *, CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 25 THEN 'Under 25' WHEN age < 35 THEN '25-34'
                       WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64'
                       ELSE '65+' END AS age_group
        FROM (SELECT *, CAST(date_sub('year', birth_date, {TODAY}) AS INTEGER) AS age
              FROM (SELECT upper(trim(regexp_replace("CID", '^NAS', ''))) AS customer_id,
                           CASE WHEN "BDATE" <= {TODAY} THEN "BDATE" END AS birth_date,
                           CASE upper(trim(coalesce("GEN", ''))) WHEN 'MALE' THEN 'Male' WHEN 'M' THEN 'Male'
                                WHEN 'FEMALE' THEN 'Female' WHEN 'F' THEN 'Female' ELSE 'N/A' END AS gender
                    FROM raw_erp_customer))""",
    "clean_erp_location": f"""
        SELECT *, CASE WHEN country IN ('Australia', 'New Zealand') THEN 'Oceania'
                       WHEN country IN ('USA', 'Canada', 'Mexico') THEN 'North America'
                       WHEN country IN ('United Kingdom', 'Germany', 'France', 'Italy', 'Spain', 'Netherlands', 'Belgium',
                                        'Austria', 'Switzerland', 'Ireland', 'Poland', 'Sweden', 'Norway', 'Denmark',
                                        'Finland') THEN 'Europe'
                       WHEN country = 'N/A' THEN 'Unknown' ELSE 'Other' END AS region
        FROM (SELECT upper(trim(replace("CID", '-', ''))) AS customer_id,
                     CASE WHEN name = '' THEN 'N/A' WHEN name IN ('Us', 'Usa', 'United States') THEN 'USA'
                          WHEN name = 'De' THEN 'Denmark' ELSE name END AS country
              FROM (SELECT *, {title('"CNTRY"')} AS name FROM raw_erp_location))""",
    # --- refined ---
    "silver_crm_customer": "SELECT * FROM clean_crm_customer WHERE customer_id IS NOT NULL",
    "silver_crm_product": "SELECT * FROM clean_crm_product WHERE product_id IS NOT NULL",
    "silver_crm_sales": "SELECT * FROM clean_crm_sales WHERE order_number IS NOT NULL",
    "silver_erp_category": "SELECT * FROM clean_erp_category WHERE category_id IS NOT NULL",
    "silver_erp_customer": "SELECT * FROM clean_erp_customer WHERE customer_id IS NOT NULL",
    "silver_erp_location": "SELECT * FROM clean_erp_location WHERE customer_id IS NOT NULL",
    # --- marts ---
    "gold_customer": """
        SELECT c.customer_id, c.customer_key, c.first_name, c.last_name, c.marital_status, c.created_date,
               coalesce(p.gender, c.gender) AS gender, p.birth_date, p.age, p.age_group, l.country, l.region
        FROM silver_crm_customer AS c
        LEFT JOIN silver_erp_customer AS p ON c.customer_key = p.customer_id
        LEFT JOIN silver_erp_location AS l ON c.customer_key = l.customer_id""",
    "gold_product": """
        SELECT p.*, c.category, c.subcategory, c.requires_maintenance
        FROM silver_crm_product AS p LEFT JOIN silver_erp_category AS c ON p.product_category = c.category_id""",
    "calendar_parts": """
        SELECT day AS date, CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(day) AS INTEGER) AS year,
               CAST(month(day) AS INTEGER) AS month, CAST(day(day) AS INTEGER) AS day_of_month,
               dayname(day) AS day_of_week, left(dayname(day), 3) AS day_of_week_abbr, monthname(day) AS month_name,
               monthname(day) || ' ' || year(day) AS month_year, CAST(quarter(day) AS INTEGER) AS quarter,
               'Q' || quarter(day) || ' ' || year(day) AS quarter_year,
               CAST(weekofyear(day) AS INTEGER) AS week_of_year, CAST(dayofyear(day) AS INTEGER) AS day_of_year,
               dayofweek(day) NOT IN (0, 6) AS is_weekday, dayofweek(day) IN (0, 6) AS is_weekend
        FROM calendar_days""",
    "calendar_days": """
        SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2000-12-31', INTERVAL 1 DAY)) AS DATE) AS day""",
    "calendar_days_of_sales": """
        SELECT CAST(unnest(generate_series(date_trunc('year', first), date_trunc('year', last) + INTERVAL 1 YEAR
                                           - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT min(order_date) AS first, max(order_date) AS last FROM silver_crm_sales)""",
}

FACT = """
        SELECT s.order_number, s.customer_id, s.product_key, s.order_date, s.ship_date, s.due_date, s.sales_amount,
               s.quantity, s.price, c.customer_key, c.first_name, c.last_name, c.marital_status,
               c.gender AS customer_gender, c.birth_date AS customer_birth_date, c.age AS customer_age,
               c.age_group AS customer_age_group, c.country AS customer_country, c.region AS customer_region,
               p.product_id, p.product_category, p.product_name, p.product_cost, p.product_line, p.product_start_date,
               p.product_end_date, p.category AS product_category_name, p.subcategory AS product_subcategory,
               p.requires_maintenance AS product_requires_maintenance, d.year AS order_year, d.month AS order_month,
               d.day_of_month AS order_day, d.day_of_week AS order_day_of_week, d.month_name AS order_month_name,
               d.quarter AS order_quarter, d.is_weekend AS order_is_weekend
        FROM silver_crm_sales AS s
        LEFT JOIN {customers} AS c ON s.customer_id = c.customer_id
        LEFT JOIN {products} AS p ON s.product_key = p.product_key {condition}
        LEFT JOIN calendar_parts AS d ON s.order_date = d.date"""
FEATURES = f"""
        SELECT order_number, customer_id, product_key, order_date, ship_date, due_date, order_year, order_month, order_day,
               order_quarter, order_month_name, order_day_of_week, order_is_weekend, sales_amount, quantity, price,
               CAST(ship_date - order_date AS INTEGER) AS days_to_ship,
               CAST(due_date - order_date AS INTEGER) AS days_until_due,
               CASE WHEN ship_date IS NULL THEN 1 WHEN ship_date <= due_date THEN 0 ELSE 1 END AS is_late_shipment,
               {r2("sales_amount / quantity")} AS price_per_unit,
               CASE WHEN product_cost > 0 THEN {r2("(price - product_cost) / price * 100")} END AS profit_margin_pct,
               CASE WHEN product_cost > 0 THEN (price - product_cost) * quantity END AS estimated_profit,
               customer_key, first_name, last_name, customer_gender, customer_age, customer_age_group,
               customer_birth_date, marital_status, customer_country, customer_region, product_id, product_name,
               product_category, product_subcategory, product_line, product_cost, product_category_name,
               product_requires_maintenance, product_start_date, product_end_date,
               CAST(order_date - product_start_date AS INTEGER) AS product_age_days,
               CASE WHEN product_end_date IS NULL OR order_date <= product_end_date THEN 1 ELSE 0 END AS is_product_active,
               CASE WHEN ship_date IS NULL THEN 1 ELSE 0 END AS missing_ship_date,
               CASE WHEN customer_age IS NULL THEN 1 ELSE 0 END AS missing_customer_age,
               CASE WHEN product_cost IS NULL OR product_cost = 0 THEN 1 ELSE 0 END AS missing_product_cost
        FROM {{fact}}
        WHERE price > 0 AND sales_amount > 0 AND quantity > 0 AND order_date IS NOT NULL"""
IN_FORCE = """AND s.order_date >= p.product_start_date
                  AND (p.next_start IS NULL OR s.order_date < p.next_start)"""
PARTS |= {
    "version_chain": """
        SELECT *, lead(product_start_date) OVER (PARTITION BY product_key ORDER BY product_start_date) AS next_start
        FROM (SELECT * FROM gold_product WHERE product_start_date IS NOT NULL QUALIFY
              row_number() OVER (PARTITION BY product_key, product_start_date ORDER BY product_id DESC) = 1)""",
    "gold_fact": FACT.format(customers="gold_customer", products="gold_product", condition=""),
    "gold_fact_effective": FACT.format(customers="single_customer", products="version_chain", condition=IN_FORCE),
    "gold_features": FEATURES.format(fact="gold_fact"),
    "gold_features_effective": FEATURES.format(fact="gold_fact_effective"),
    "present_months": """
        SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(sum(sales_amount) AS BIGINT) AS total_sales
        FROM silver_crm_sales WHERE order_date IS NOT NULL GROUP BY 1""",
    "monthly": """
        SELECT month, coalesce(total_sales, 0) AS total_sales
        FROM (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM present_months)
        LEFT JOIN present_months USING (month)""",
    "spend": """
        SELECT customer_id, sum(sales_amount) AS total_sales, count(*) AS sales_lines
        FROM silver_crm_sales WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "line_items": """
        SELECT product_line, month, coalesce(items, 0) AS items
        FROM (SELECT product_line, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
              FROM present_line_items GROUP BY product_line)
        LEFT JOIN present_line_items USING (product_line, month)""",
    "present_line_items": """
        SELECT product_line, CAST(date_trunc('month', order_date) AS DATE) AS month, sum(quantity) AS items
        FROM gold_fact_effective WHERE order_date IS NOT NULL AND product_line IS NOT NULL GROUP BY 1, 2""",
    "activity": f"""
        SELECT customer_id, CAST({TODAY} - max(order_date) AS INTEGER) AS days_since_order,
               count(DISTINCT order_number) AS orders, CAST(sum(sales_amount) AS BIGINT) AS total_sales
        FROM silver_crm_sales WHERE customer_id IS NOT NULL AND order_date IS NOT NULL GROUP BY customer_id""",
    "bought": """
        SELECT customer_id, product_key, sum(quantity) AS items FROM silver_crm_sales
        WHERE customer_id IS NOT NULL AND product_key IS NOT NULL GROUP BY ALL""",
    "single_customer": """
        SELECT * FROM gold_customer WHERE customer_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY
            customer_key NULLS LAST, first_name NULLS LAST, last_name NULLS LAST, marital_status NULLS LAST,
            gender NULLS LAST, birth_date NULLS LAST, age NULLS LAST, age_group NULLS LAST, country NULLS LAST,
            region NULLS LAST) = 1""",
    "region_ranks": """
        SELECT region, product_key, row_number() OVER (PARTITION BY region ORDER BY sum(items) DESC, product_key) AS rank
        FROM bought JOIN single_customer USING (customer_id) WHERE region IS NOT NULL GROUP BY region, product_key""",
    "best_offers": """
        SELECT customer_id, arg_min(r.product_key, rank) AS product_key, min(rank) AS rank
        FROM single_customer JOIN region_ranks AS r USING (region)
        WHERE NOT EXISTS (SELECT 1 FROM bought AS b WHERE b.customer_id = single_customer.customer_id
                          AND b.product_key = r.product_key)
        GROUP BY customer_id""",
    "spender": "SELECT * FROM spend JOIN single_customer USING (customer_id)",
}


# --- statements ------------------------------------------------------------------------------------------------------

# Columns, rule names and value domains.
FEED_COLUMNS = {
    "crm_customer": {"cst_id": "bigint", "cst_key": "string", "cst_firstname": "string", "cst_lastname": "string",
                     "cst_marital_status": "string", "cst_gndr": "string", "cst_create_date": "date"},
    "crm_product": {"prd_id": "bigint", "prd_key": "string", "prd_nm": "string", "prd_cost": "int", "prd_line": "string",
                    "prd_start_dt": "date", "prd_end_dt": "date"},
    "crm_sales": {"sls_ord_num": "string", "sls_prd_key": "string", "sls_cust_id": "bigint", "sls_order_dt": "int",
                  "sls_ship_dt": "int", "sls_due_dt": "int", "sls_sales": "int", "sls_quantity": "int",
                  "sls_price": "int"},
    "erp_category": {"ID": "string", "CAT": "string", "SUBCAT": "string", "MAINTENANCE": "string"},
    "erp_customer": {"CID": "string", "BDATE": "date", "GEN": "string"},
    "erp_location": {"CID": "string", "CNTRY": "string"},
}
VIOLATED = {
    "crm_customer": {
        "valid_customer_id": "customer_id IS NULL",
        "valid_gender": "gender NOT IN ('Female', 'Male', 'N/A')",
        "valid_marital_status": "marital_status NOT IN ('Married', 'Single', 'N/A')",
        "valid_created_date": f"created_date IS NULL OR created_date > {TODAY}",
        "complete_names": "first_name = 'N/A' OR last_name = 'N/A'",
    },
    "crm_product": {
        "valid_product_id": "product_id IS NULL",
        "valid_product_key": "product_key IS NULL",
        "valid_product_name": "product_name IS NULL",
        "valid_product_cost": "product_cost < 0",
        "valid_product_dates": "product_start_date IS NULL OR product_start_date > product_end_date",
        "valid_product_line": "product_line NOT IN ('Mountain', 'Road', 'Touring', 'Other Sales', 'N/A')",
    },
    "crm_sales": {
        "valid_order_number": "order_number IS NULL",
        "valid_quantity": "quantity < 0",
        "valid_sales_amount": "sales_amount < 0",
        "valid_price": "price < 0",
        "valid_order_date": f"order_date < DATE '1990-01-01' OR order_date > {TODAY}",
        "valid_ship_sequence": "ship_date < order_date",
        "valid_due_sequence": "due_date < order_date",
    },
    "erp_category": {
        "valid_category_id": "category_id IS NULL",
        "valid_category": "category IS NULL",
        "valid_subcategory": "subcategory IS NULL",
        "valid_maintenance_flag": "requires_maintenance IS NULL",
    },
    "erp_customer": {
        "valid_customer_id": "customer_id IS NULL",
        "valid_gender": "gender NOT IN ('Female', 'Male', 'N/A')",
        "valid_birth_date": f"birth_date > {TODAY}",
        "valid_age": "age < 0 OR age > 120",
        "valid_age_group":
            "age_group NOT IN ('Unknown', 'Under 25', '25-34', '35-44', '45-54', '55-64', '65+')",
    },
    "erp_location": {
        "valid_customer_id": "customer_id IS NULL",
        "valid_country": "country IS NULL",
        "valid_region": "region NOT IN ('Oceania', 'North America', 'Europe', 'Unknown', 'Other')",
    },
}
DROPPING = {"valid_order_number", "valid_product_id", "valid_category_id"}


def rule_report(feed: str) -> str:
    def line(rule: str, violated: str) -> str:
        drops = rule in DROPPING or (rule == "valid_customer_id")
        action = "drop" if drops else "warn"
        return (
            f"SELECT '{rule}' AS \"rule\", '{action}' AS \"action\", "
            f"count(*) FILTER (WHERE {violated}) AS violations FROM clean_{feed}"
        )

    return " UNION ALL ".join(line(*item) for item in VIOLATED[feed].items())


def profile(feed: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{feed}' AS table_name, '{c}' AS column_name, '{kind}' AS data_type, count(*) AS records, "
        f'count(*) - count("{c}") AS nulls, count(DISTINCT "{c}") AS distinct_values, '
        f'CAST(min("{c}") AS VARCHAR) AS min_value, CAST(max("{c}") AS VARCHAR) AS max_value FROM raw_{feed}'
        for c, kind in FEED_COLUMNS[feed].items()
    )


def link(name: str, child: str, child_key: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{name}' AS link, count(*) AS referring_rows, count(*) FILTER (WHERE {child_key} NOT IN "
        f"(SELECT {parent_key} FROM {parent} WHERE {parent_key} IS NOT NULL)) AS orphan_rows "
        f"FROM {child} WHERE {child_key} IS NOT NULL"
    )


def driver(column: str) -> str:
    return (
        f"SELECT '{column}' AS driver, {column} AS value, count(*) AS customers, "
        f"CAST(sum(total_sales) AS BIGINT) AS total_sales, {r2('avg(total_sales)')} AS avg_spend "
        f"FROM spender GROUP BY {column}"
    )


def forecast(series: str, value: str, key: str = "") -> str:
    """Straight line through a monthly series, continued for three months."""
    number = "(year({0}) - 2000) * 12 + month({0})"
    month = "CAST(last + to_months(CAST(step AS INTEGER)) AS DATE)"
    lead, group = (f"{key}, ", f" GROUP BY {key}") if key else ("", "")
    return f"""
        SELECT {lead}{month} AS month, round(intercept + slope * ({number.format(month)})) AS forecast
        FROM (SELECT {lead}regr_slope({value}, {number.format("month")}) AS slope,
                     regr_intercept({value}, {number.format("month")}) AS intercept, max(month) AS last
              FROM {series}{group}), range(1, 4) AS steps(step)"""


def pct(part: str, whole: str) -> str:
    return r2(f"CAST({part} AS DOUBLE) * 100 / nullif({whole}, 0)")


def read_back(feed: str) -> str:
    """A feed after a trip through CSV, which does not tell empty text from NULL."""
    columns = [
        f'nullif("{c}", \'\') AS "{c}"' if kind == "string" else f'"{c}"' for c, kind in FEED_COLUMNS[feed].items()
    ]
    return f"SELECT {', '.join(columns)}, false AS is_corrupt FROM raw_{feed}"


STATEMENTS = {
    **{f"ingest_csv_{feed}": read_back(feed) for feed in FEED_COLUMNS},
    "ingest_corrupt_rows": """
        SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey END AS cst_id, 'AW' AS cst_key,
               DATE '2020-01-01' AS cst_create_date,
               CASE c_custkey % 10 WHEN 0 THEN 'x' || c_custkey || ',AW,2020-01-01'
                    WHEN 1 THEN c_custkey || ',AW,2020-01-01,surplus' END AS corrupt_record
        FROM customer""",
    "ingest_merged_schema": """
        SELECT "CID", CASE WHEN CAST(right("CID", 1) AS INTEGER) % 3 < 2 THEN nullif("CNTRY", '') END AS "CNTRY"
        FROM raw_erp_location""",
    "peek_raw": f"""
        SELECT * EXCLUDE (is_corrupt) REPLACE (CAST(cst_id AS INTEGER) AS cst_id)
        FROM ({read_back("crm_customer")})""",
    **{f"refined_{feed}": f"SELECT * FROM silver_{feed}" for feed in FEED_COLUMNS},
    "dedup_best_record": "SELECT customer_id, first_name, created_date FROM clean_crm_customer",
    "version_intervals": "SELECT * FROM product_versions",
    "date_guards": """
        SELECT sls_ord_num, sls_order_dt, sls_ship_dt, sls_due_dt, order_date, ship_date, due_date FROM sales_dates""",
    **{f"rules_{feed}": rule_report(feed) for feed in VIOLATED},
    "dim_customer": "SELECT * FROM gold_customer",
    "dim_product": "SELECT * FROM gold_product",
    "dim_calendar": PARTS["calendar_parts"].replace("FROM calendar_days", "FROM calendar_days_of_sales"),
    "fact_sales": "SELECT * FROM gold_fact",
    "fact_sales_effective": "SELECT * FROM gold_fact_effective",
    "fact_sales_ml": "SELECT * FROM gold_features",
    "kpi_total_sales": "SELECT CAST(sum(sales_amount) AS BIGINT) AS total_sales FROM gold_fact",
    "kpi_total_items": "SELECT CAST(sum(quantity) AS BIGINT) AS total_items FROM gold_fact",
    "kpi_avg_price": f"SELECT {r2('avg(price)')} AS avg_sales FROM gold_fact",
    "kpi_orders": "SELECT count(DISTINCT order_number) AS total_orders FROM gold_fact",
    "kpi_products": "SELECT count(DISTINCT product_name) AS total_products FROM gold_product",
    "kpi_customers": "SELECT count(customer_key) AS total_customers FROM gold_customer",
    "kpi_buyers": "SELECT count(DISTINCT customer_key) AS total_customers FROM gold_fact",
    "order_span": """
        SELECT min(order_date) AS first_order_date, max(order_date) AS last_order_date,
               date_sub('year', min(order_date), max(order_date)) AS order_range_years
        FROM gold_fact""",
    "customer_age_span": f"""
        SELECT date_sub('year', max(birth_date), {TODAY}) AS youngest_age,
               date_sub('year', min(birth_date), {TODAY}) AS oldest_age
        FROM gold_customer""",
    "countries": "SELECT DISTINCT country FROM gold_customer",
    "product_hierarchy": "SELECT DISTINCT category, subcategory, product_name FROM gold_product",
    "business_report": f"""
        SELECT 'Total Sales' AS measure_name, CAST(sum(sales_amount) AS DOUBLE) AS measure_value FROM gold_fact
        UNION ALL SELECT 'Total Items Sold', sum(quantity) FROM gold_fact
        UNION ALL SELECT 'Average Sales', {r2('avg(price)')} FROM gold_fact
        UNION ALL SELECT 'Total Nr. Orders', count(DISTINCT order_number) FROM gold_fact
        UNION ALL SELECT 'Total Nr. Products', count(product_name) FROM gold_product
        UNION ALL SELECT 'Total Nr. Customers', count(customer_key) FROM gold_customer
        UNION ALL SELECT 'Total Customers with Orders', count(DISTINCT customer_key) FROM gold_fact""",
    "classic_dim_erp_category": """
        SELECT "ID" AS category_id, "CAT" AS category, "SUBCAT" AS subcategory, "MAINTENANCE" AS maintenance_flag,
               'erp_category' AS source_file FROM raw_erp_category""",
    "classic_dim_erp_customer": f"""
        SELECT "CID" AS customer_id, "BDATE" AS birth_date,
               CASE WHEN "GEN" IN ('M', 'Male') THEN 'M' WHEN "GEN" IN ('F', 'Female') THEN 'F' END AS gender,
               'erp_customer' AS source_file
        FROM raw_erp_customer WHERE "BDATE" IS NULL OR "BDATE" <= {TODAY}""",
    "classic_dim_erp_location": """
        SELECT "CID" AS customer_id, "CNTRY" AS country_code, 'erp_location' AS source_file
        FROM raw_erp_location WHERE length("CNTRY") BETWEEN 2 AND 3""",
    "classic_dim_crm_customer": """
        SELECT cst_id AS customer_id, cst_key AS customer_key, cst_firstname AS first_name, cst_lastname AS last_name,
               cst_marital_status AS marital_status, cst_gndr AS gender, cst_create_date AS customer_create_date,
               'crm_customer' AS source_file
        FROM raw_crm_customer WHERE cst_id IS NOT NULL""",
    "classic_dim_crm_product": """
        SELECT prd_id AS product_id, prd_key AS product_key, prd_nm AS product_name,
               CAST(CAST(prd_cost AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS product_cost, prd_line AS product_line,
               prd_start_dt AS product_start_date, prd_end_dt AS product_end_date, 'crm_product' AS source_file
        FROM raw_crm_product WHERE prd_cost IS NULL OR prd_cost >= 0""",
    "classic_fct_sales": f"""
        SELECT sls_ord_num AS sales_order_number, sls_prd_key AS product_key, sls_cust_id AS customer_id,
               {to_date("sls_order_dt")} AS order_date, {to_date("sls_ship_dt")} AS ship_date,
               {to_date("sls_due_dt")} AS due_date,
               CAST(CAST(sls_sales AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS sales_amount, sls_quantity AS quantity,
               CAST(CAST(sls_price AS DECIMAL(18,2)) / 100 AS DECIMAL(10,2)) AS unit_price, 'crm_sales' AS source_file
        FROM raw_crm_sales
        WHERE sls_quantity > 0 AND (sls_sales IS NULL OR sls_sales >= 0) AND (sls_price IS NULL OR sls_price >= 0)""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{feed}' AS table_name, count(*) AS records FROM raw_{feed}" for feed in FEED_COLUMNS
    ),
    "table_profile": " UNION ALL ".join(profile(feed) for feed in FEED_COLUMNS),
    "relationship_check": " UNION ALL ".join([
        link("sales.customer_id -> customer.customer_id", "silver_crm_sales", "customer_id", "silver_crm_customer",
             "customer_id"),
        link("sales.product_key -> product.product_key", "silver_crm_sales", "product_key", "silver_crm_product",
             "product_key"),
        link("location.customer_id -> person.customer_id", "silver_erp_location", "customer_id", "silver_erp_customer",
             "customer_id"),
        link("customer.customer_key -> person.customer_id", "silver_crm_customer", "customer_key", "silver_erp_customer",
             "customer_id"),
    ]),
    "publish_roundtrip": "SELECT * FROM silver_crm_sales",
    "clustered_roundtrip": "SELECT * FROM gold_features_effective",
    "top_products": """
        SELECT product_id, product_name, CAST(sum(sales_amount) AS BIGINT) AS total_sales,
               CAST(sum(quantity) AS BIGINT) AS total_items
        FROM gold_fact_effective WHERE product_id IS NOT NULL GROUP BY product_id, product_name
        ORDER BY total_sales DESC, product_id, product_name LIMIT 10""",
    "top_customers": """
        SELECT customer_id, CAST(sum(sales_amount) AS BIGINT) AS total_sales, count(DISTINCT order_number) AS orders,
               customer_key, first_name, last_name, country
        FROM silver_crm_sales JOIN single_customer USING (customer_id)
        GROUP BY customer_id, customer_key, first_name, last_name, country
        ORDER BY total_sales DESC, customer_id LIMIT 10""",
    "monthly_growth": f"""
        SELECT month, total_sales, previous_sales, {pct("(total_sales - previous_sales)", "previous_sales")} AS growth_pct
        FROM (SELECT *, lag(total_sales) OVER (ORDER BY month) AS previous_sales FROM monthly)""",
    "weak_regions": f"""
        SELECT region, total_sales, {pct("total_sales * regions", "everywhere")} AS pct_of_average,
               total_sales * regions < everywhere AS is_below_average
        FROM (SELECT region, CAST(sum(total_sales) AS BIGINT) AS total_sales, count(*) OVER () AS regions,
                     CAST(sum(sum(total_sales)) OVER () AS BIGINT) AS everywhere
              FROM spender WHERE region IS NOT NULL GROUP BY region)""",
    "spend_drivers": " UNION ALL ".join(
        driver(column) for column in ["age_group", "region", "gender", "marital_status"]
    ),
    "spend_correlation": """
        SELECT round(corr(age, total_sales), 6) AS age_spend_corr,
               round(corr(sales_lines, total_sales), 6) AS purchases_spend_corr
        FROM spender""",
    "category_margin": f"""
        SELECT product_category_name, revenue, cost, revenue - cost AS margin, {pct("(revenue - cost)", "revenue")}
               AS margin_pct
        FROM (SELECT product_category_name, CAST(sum(price * quantity) AS BIGINT) AS revenue,
                     CAST(sum(product_cost * quantity) AS BIGINT) AS cost
              FROM gold_features_effective WHERE product_cost > 0 GROUP BY 1)""",
    "ship_delay": f"""
        SELECT product_category_name, count(days_to_ship) AS shipped,
               round(quantile_cont(days_to_ship, 0.5), 6) AS median_days,
               round(quantile_cont(days_to_ship, 0.9), 6) AS p90_days,
               {pct("sum(is_late_shipment)", "count(*)")} AS late_pct
        FROM gold_features_effective GROUP BY product_category_name""",
    "sales_trend": f"""
        SELECT month, total_sales,
               {r2("avg(total_sales) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")} AS moving_average,
               CAST(sum(total_sales) OVER (ORDER BY month) AS BIGINT) AS running_total
        FROM monthly""",
    "sales_forecast": forecast("monthly", "total_sales"),
    "demand_forecast": forecast("line_items", "items", "product_line"),
    "customer_segments": """
        SELECT *, CASE WHEN days_since_order <= (SELECT avg(days_since_order) FROM activity) THEN 'recent' ELSE 'lapsed' END
               || '-' || CASE WHEN orders >= (SELECT avg(orders) FROM activity) THEN 'frequent' ELSE 'rare' END
               || '-' || CASE WHEN total_sales >= (SELECT avg(total_sales) FROM activity) THEN 'high' ELSE 'low' END
               AS segment
        FROM activity""",
    "recommendations": """
        SELECT customer_id, product_key, rank FROM single_customer LEFT JOIN best_offers USING (customer_id)""",
}


def statement(body: str) -> str:
    """The body with the named subqueries it needs, in order of use."""
    needed: list[str] = []
    entered: list[str] = []

    def visit(sql: str) -> None:
        for name in re.findall(r"\w+", sql):
            if name in PARTS and name not in needed and name not in entered:
                entered.append(name)  # a step may name itself
                visit(PARTS[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({PARTS[name].strip()})" for name in needed) + "\n" + body.strip()


LOADED = "'2025-01-01 00:00:00'"
STAMPED = {
    **{f"silver.{feed}": ("ingest_timestamp", f"silver_{feed}") for feed in FEED_COLUMNS},
    "gold.dim_customer": ("gold_processed_timestamp", "gold_customer"),
    "gold.dim_product": ("gold_processed_timestamp", "gold_product"),
    "gold.dim_calendar": ("silver_processed_timestamp", "(SELECT unnest(range(DATE '1995-01-01', DATE '2001-01-01', INTERVAL 1 DAY)))"),
    "gold.fact_sales_effective": ("gold_processed_timestamp", "gold_fact_effective"),
    "gold.fact_sales_ml": ("ml_processed_timestamp", "gold_features_effective"),
}
STATEMENTS |= {
    "load_stamps": " UNION ALL ".join(
        [f"SELECT '{name}' AS table_name, '{stamp}' AS stamp, {LOADED} AS loaded_at, count(*) AS records FROM {rows}" for name, (stamp, rows) in STAMPED.items()]
        + [f"SELECT 'classic.{name[8:]}', '{stamp}', {LOADED}, count(*) FROM ({sql})"
           for name, sql in STATEMENTS.items() if name.startswith("classic_") for stamp in ("silver_load_timestamp", "bronze_load_timestamp")]),
    "file_lineage": " UNION ALL ".join(
        f"SELECT '{feed}' AS table_name, '{feed}' AS folder, {LOADED} AS ingested_at, count(*) AS records FROM raw_{feed}" for feed in FEED_COLUMNS),
}
PARTS |= oracle_models.PARTS
STATEMENTS |= oracle_models.STATEMENTS


def oracle_sql() -> dict[str, str]:
    return {name: statement(body) for name, body in STATEMENTS.items()}
