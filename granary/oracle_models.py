"""DuckDB counterparts of the models: seeds, rounds, elimination and folds written out in SQL."""

from __future__ import annotations

from itertools import product

TODAY_SEED, CLUSTERS, TURNS, ROUNDS = 7, 5, 3, 20
PENALTY, VANISHING = 0.001, 1e-12
PERIOD = 12
SHARES = list(product((0.1, 0.3, 0.6), (0.0, 0.1), (0.0, 0.2, 0.5)))  # level, trend, season


# --- k-means ---------------------------------------------------------------------------------------------------------

DIMENSIONS = 3


def distance(a: str, b: str) -> str:
    return " + ".join(f"(({a}[{i}] - {b}[{i}]) / s[{i}]) * (({a}[{i}] - {b}[{i}]) / s[{i}])" for i in range(1, DIMENSIONS + 1))


def variate(turn: int) -> str:
    return f"-ln((CAST('0x' || substr(md5('{TODAY_SEED}:{turn}:' || customer_id), 1, 13) AS BIGINT)::DOUBLE + 1) / 4503599627370496)"


def deviation(c: str) -> str:
    return f"coalesce(nullif(sqrt((count(*) * sum({c}::HUGEINT * {c}) - sum({c})::HUGEINT * sum({c}))::DOUBLE) / count(*), 0), 1)"


DISTANCES = f"list_transform(cs, lambda c: {distance('x', 'c')})"

PARTS = {
    "points": f"""
        SELECT activity.*, [days_since_order, orders, total_sales]::DOUBLE[] AS x, s FROM activity,
        (SELECT [{", ".join(map(deviation, ("days_since_order", "orders", "total_sales")))}] AS s FROM activity)""",
    "candidates_0": f"SELECT [x] AS cs FROM points ORDER BY {variate(0)}, customer_id LIMIT 1",
    **{
        f"candidates_{t}": f"""
        SELECT list_concat(any_value(cs), list(x ORDER BY late, customer_id)) AS cs FROM (
            SELECT cs, x, customer_id, {variate(t)} / far AS late
            FROM (SELECT *, list_min({DISTANCES}) AS far FROM points, candidates_{t - 1}) WHERE far > 0
            ORDER BY late, customer_id LIMIT {2 * CLUSTERS})"""
        for t in range(1, TURNS + 1)
    },
    "weighed": f"""
        SELECT any_value(cs) AS cs, any_value(s) AS s, list(coalesce(n, 0) ORDER BY j) AS ws
        FROM (SELECT cs, unnest(range(1, len(cs) + 1)) AS j FROM candidates_{TURNS})
        LEFT JOIN (SELECT list_position(ds, list_min(ds)) AS j, count(*) AS n
                   FROM (SELECT {DISTANCES} AS ds FROM points, candidates_{TURNS}) GROUP BY 1) USING (j),
        (SELECT any_value(s) AS s FROM points)""",
    "seeds_0": """
        SELECT cs, s, ws, cs[1:0] AS chosen, list_transform(cs, lambda c: 'inf'::DOUBLE) AS near, ws::DOUBLE[] AS gain FROM weighed""",
    **{
        f"seeds_{k}": f"""
        SELECT cs, s, ws, chosen, near, list_transform(range(1, len(cs) + 1), lambda i: ws[i] * near[i]) AS gain FROM (
            SELECT * REPLACE (list_append(chosen, best) AS chosen,
                              list_transform(range(1, len(cs) + 1), lambda i: least(near[i], {distance('cs[i]', 'best')})) AS near)
            FROM (SELECT *, cs[list_position(gain, list_max(gain))] AS best FROM seeds_{k - 1}))"""
        for k in range(1, CLUSTERS + 1)
    },
    "rounds": f"""
        SELECT 0 AS r, chosen AS cs FROM seeds_{CLUSTERS}
        UNION ALL
        SELECT r + 1, list_transform(range(1, len(cs) + 1), lambda j: coalesce(list_filter(found, lambda f: f.j = j)[1].m, cs[j]))
        FROM (SELECT r, any_value(cs) AS cs, list({{'j': j, 'm': m}}) AS found FROM (
                SELECT r, any_value(cs) AS cs, j, [{", ".join(f"sum(x[{i}]) / count(*)" for i in range(1, DIMENSIONS + 1))}] AS m FROM (
                    SELECT r, cs, x, list_position(ds, list_min(ds)) AS j
                    FROM (SELECT r, cs, x, {DISTANCES} AS ds FROM rounds, points WHERE r < {ROUNDS})) GROUP BY r, j) GROUP BY r)""",
    "centres": """
        SELECT list_transform(list_reverse_sort(list_transform(cs, lambda c: list_reverse(c))), lambda c: list_reverse(c)) AS cs
        FROM rounds ORDER BY r DESC LIMIT 1""",
}


# --- regression ------------------------------------------------------------------------------------------------------

FEATURES = {
    "quantity": "coalesce(quantity, 0)",
    "product_cost": "coalesce(product_cost, 0)",
    "product_age_days": "coalesce(product_age_days, 0)",
    "customer_age": "coalesce(customer_age, 50) - 50",
    "days_until_due": "coalesce(days_until_due, 0)",
    "order_is_weekend": "coalesce(order_is_weekend::INTEGER, 0)",
    "is_product_active": "is_product_active",
    "missing_customer_age": "missing_customer_age",
    "missing_product_cost": "missing_product_cost",
    "quarter_2": "coalesce((order_quarter = 2)::INTEGER, 0)",
    "quarter_3": "coalesce((order_quarter = 3)::INTEGER, 0)",
    "quarter_4": "coalesce((order_quarter = 4)::INTEGER, 0)",
}
P = len(FEATURES)
EACH, ALL = f"range(1, {P + 1})", f"range(1, {P + 2})"


def elimination(size: int, keep: str, source: str) -> str:
    """Matrices a with the right-hand side in their last column, brought to the unit matrix column by column."""
    for k in range(1, size + 1):
        source = f"""(SELECT {keep}, list_transform(range(1, {size + 1}), lambda i: list_transform(range(1, {size + 2}), lambda j: CASE WHEN i = {k}
            THEN a[{k}][j] / a[{k}][{k}] ELSE a[i][j] - a[i][{k}] * a[{k}][j] / a[{k}][{k}] END)) AS a FROM {source})"""
    return source


def regression(rows: str) -> dict[str, str]:
    """Named steps from rows (group g, vector v of features and target) to line: g, n, slopes, intercept."""
    products = "[" + ", ".join("[" + ", ".join(f"sum(v[{i}] * v[{j}]) / count(*)" for j in range(1, P + 2)) + "]" for i in range(1, P + 2)) + "]"
    means = "[" + ", ".join(f"sum(v[{i}]) / count(*)" for i in range(1, P + 2)) + "]"
    return {
        "gram": f"SELECT g, count(*) AS n, {means} AS mean, {products} AS m FROM {rows} GROUP BY g",
        "spreads": f"""
            SELECT *, list_transform({EACH}, lambda i: CASE WHEN m[i][i] - mean[i] * mean[i] > {VANISHING} * m[i][i]
                THEN sqrt(m[i][i] - mean[i] * mean[i]) ELSE 0 END) AS scale FROM gram""",
        "normal": f"""
            SELECT g, n, mean, scale, list_transform({EACH}, lambda i: list_transform({ALL}, lambda j: CASE
                WHEN scale[i] = 0 OR (j <= {P} AND scale[j] = 0) THEN (i = j)::INTEGER::DOUBLE
                WHEN j > {P} THEN (m[i][j] - mean[i] * mean[j]) / scale[i]
                ELSE (m[i][j] - mean[i] * mean[j]) / (scale[i] * scale[j]) + CASE WHEN i = j THEN {PENALTY} ELSE 0 END END)) AS a FROM spreads""",
        "slopes": f"""
            SELECT g, n, mean, list_transform({EACH}, lambda i: CASE WHEN scale[i] = 0 THEN 0 ELSE a[i][{P + 1}] / scale[i] END) AS slopes
            FROM {elimination(P, 'g, n, mean, scale', 'normal')}""",
        "line": f"SELECT g, n, slopes, mean[{P + 1}] - list_sum(list_transform({EACH}, lambda i: slopes[i] * mean[i])) AS intercept FROM slopes",
    }


VECTOR = f"[{', '.join(FEATURES.values())}, sales_amount]::DOUBLE[]"
EXPECTED = f"intercept + list_sum(list_transform({EACH}, lambda i: slopes[i] * v[i]))"
PARTS["vectors"] = f"SELECT order_number, product_key, sales_amount, order_year, {VECTOR} AS v FROM gold_features_effective"


def with_steps(steps: dict[str, str], body: str) -> str:
    named = ", ".join(f"{name} AS ({sql})" for name, sql in steps.items())
    return f"SELECT * FROM (WITH RECURSIVE {named} SELECT * FROM ({body}))"


# --- factors ---------------------------------------------------------------------------------------------------------

RANK, FACTOR_ROUNDS, TRUST, FACTOR_PENALTY, OFFERS = 6, 4, 2.0, 1.0, 30
FACTOR_DIMENSIONS = range(1, RANK + 1)


def product_sum(a: str, b: str) -> str:
    return " + ".join(f"{a}[{i}] * {b}[{i}]" for i in FACTOR_DIMENSIONS)


def factors() -> dict[str, str]:
    """Named steps: u_1 to u_ROUNDS of customers, v_0 to v_ROUNDS of products, as k and f; the Gram matrix g of each."""
    start = ", ".join(f"CAST('0x' || substr(md5('{TODAY_SEED}:{k}:' || product_key), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496" for k in range(RANK))
    square = ", ".join("[" + ", ".join(f"sum(f[{i}] * f[{j}])" for j in FACTOR_DIMENSIONS) + "]" for i in FACTOR_DIMENSIONS)
    steps = {
        "amounts": "SELECT customer_id, product_key, items::DOUBLE AS amount FROM bought WHERE items > 0",
        "v_0": f"SELECT product_key AS k, [{start}] AS f FROM (SELECT DISTINCT product_key FROM amounts)",
        "g_v_0": f"SELECT [{square}] AS g FROM v_0",
    }
    for r in range(1, FACTOR_ROUNDS + 1):
        for name, of, by, held in ((f"u_{r}", "customer_id", "product_key", f"v_{r - 1}"), (f"v_{r}", "product_key", "customer_id", f"u_{r}")):
            rows = ", ".join(
                "[" + ", ".join(f"sum({TRUST} * amount * f[{i}] * f[{j}])" for j in FACTOR_DIMENSIONS) + f", sum((1 + {TRUST} * amount) * f[{i}])]" for i in FACTOR_DIMENSIONS)
            sums = f"(SELECT {of} AS k, [{rows}] AS own FROM amounts JOIN {held} ON {by} = k GROUP BY {of})"
            normal = f"""(SELECT k, list_transform(range(1, {RANK + 1}), lambda i: list_transform(range(1, {RANK + 2}), lambda j: own[i][j]
                + CASE WHEN j > {RANK} THEN 0 ELSE g[i][j] + CASE WHEN i = j THEN {FACTOR_PENALTY} ELSE 0 END END)) AS a FROM {sums}, g_{held})"""
            steps[name] = f"SELECT k, list_transform(a, lambda row: row[{RANK + 1}]) AS f FROM {elimination(RANK, 'k', normal)}"
            steps[f"g_{name}"] = f"SELECT [{square}] AS g FROM {name}"
    return steps


def factor_loss(r: int) -> str:
    dot, c = product_sum("u.f", "v.f"), f"(1 + {TRUST} * amount)"
    traces = f"""(SELECT list_sum(list_transform(range(1, {RANK + 1}), lambda i: list_sum(list_transform(range(1, {RANK + 1}), lambda j: a.g[i][j] * b.g[i][j]))
        + {FACTOR_PENALTY} * (a.g[i][i] + b.g[i][i]))) FROM g_u_{r} a, g_v_{r} b)"""
    return f"""SELECT {r} AS round, round((SELECT sum({c} * (1 - ({dot})) * (1 - ({dot})) - ({dot}) * ({dot}))
        FROM amounts JOIN u_{r} u ON customer_id = u.k JOIN v_{r} v ON product_key = v.k) + {traces}, 4) AS loss"""


# --- series ----------------------------------------------------------------------------------------------------------


def folded(series: str, value: str, key: str) -> dict[str, str]:
    """Named steps from a monthly series to states: key, i (months before), level, trend, season, of the best parameters."""
    year = "list_sum(vs[1:12]) / 12"
    smooth = "CASE WHEN n >= 24 THEN {0} ELSE 0 END"
    return {
        "arrays": f"""
            SELECT {key} AS k, list({value}::DOUBLE ORDER BY month) AS vs, count(*) AS n, max(month) AS last
            FROM {series} WHERE month IS NOT NULL GROUP BY {key}""",
        "grid": " UNION ALL ".join(f"SELECT {i} AS p, {a}::DOUBLE AS a, {b}::DOUBLE AS b, {c}::DOUBLE AS c" for i, (a, b, c) in enumerate(SHARES)),
        "fold": f"""
            SELECT k, vs, n, p, a, {smooth.format('b')} AS b, {smooth.format('c')} AS c, 0 AS i, 0.0::DOUBLE AS error,
                CASE WHEN n >= 24 THEN {year} ELSE vs[1] END AS level,
                CASE WHEN n >= 24 THEN (list_sum(vs[13:24]) / 12 - {year}) / 12 ELSE 0 END AS trend,
                CASE WHEN n >= 24 THEN list_transform(vs[1:12], lambda v: v - {year}) ELSE list_transform(range(12), lambda v: 0.0::DOUBLE) END AS season
            FROM arrays, grid
            UNION ALL
            SELECT k, vs, n, p, a, b, c, i + 1, error + off * off, next_, b * (next_ - level) + (1 - b) * trend,
                list_append(season[2:], c * (v - next_) + (1 - c) * season[1])
            FROM (SELECT *, v - level - trend - season[1] AS off, a * (v - season[1]) + (1 - a) * (level + trend) AS next_
                  FROM (SELECT *, vs[i + 1] AS v FROM fold WHERE i < n))""",
        "states": "SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY k, i ORDER BY error, p) = 1",
    }


def ahead(step: str) -> str:
    return f"level + {step} * trend + season[({step} - 1) % 12 + 1]"


def seasonal(series: str, value: str, key: str) -> str:
    return with_steps(folded(series, value, key), f"""
        SELECT f.k AS {key}, CAST(last + to_months(CAST(step AS INTEGER)) AS DATE) AS month, round({ahead('step')}, 4) AS forecast,
            g.a AS level_share, g.b AS trend_share, g.c AS season_share
        FROM states f JOIN arrays USING (k) JOIN grid g USING (p), range(1, 4) AS steps(step) WHERE f.i = f.n""")


def backtest(series: str, value: str, key: str) -> str:
    steps = folded(series, value, key)
    mean = "list_sum(vs[1:i]) / i"
    slope = f"(list_sum(list_transform(range(1, i + 1), lambda t: vs[t] * t)) - {mean} * i * (i + 1) / 2) / ((i::DOUBLE * i * i - i) / 12)"
    models = {
        "last": "vs[i]", "mean": mean, "line": f"{mean} + {slope} * (i + step - (i + 1) / 2)",
        "year_ago": "vs[i - 11 + (step - 1) % 12]", "season": ahead("step"),
    }
    rows = " UNION ALL ".join(f"SELECT '{name}' AS model, step, vs[i + step] AS actual, {sql} AS forecast FROM cuts" for name, sql in models.items())
    steps["cuts"] = "SELECT * FROM states, range(1, 4) AS steps(step) WHERE i >= 24 AND i + step <= n"
    return with_steps(steps, f"""
        SELECT model, step::INTEGER AS step, count(*) AS forecasts, round(avg(abs(forecast - actual)), 4) AS mean_error,
            round(sqrt(avg((forecast - actual) * (forecast - actual))), 4) AS root_mean_square_error,
            round(100 * sum(abs(forecast - actual)) / sum(abs(actual)), 4) AS error_pct
        FROM ({rows}) GROUP BY model, step""")


# --- tree ------------------------------------------------------------------------------------------------------------

ATTRIBUTES, ORDERED = ["age_group", "region", "gender", "marital_status", "age"], "'age'"
DEPTH, LEAST = 3, 20


def grown() -> dict[str, str]:
    """Named steps: rows_0 to rows_DEPTH with the node of every customer, and the splits of each level."""
    attributes = ", ".join(f"{{'place': {i}, 'attribute': '{a}', 'value': coalesce(CAST({a} AS VARCHAR), '?')}}" for i, a in enumerate(ATTRIBUTES))
    steps = {"rows_0": f"SELECT CAST(total_sales AS BIGINT) AS t, [{attributes}] AS attributes, 1 AS node FROM spender"}
    for level in range(DEPTH):
        steps[f"bins_{level}"] = f"""
            SELECT node, a.place AS place, a.attribute AS attribute, a.value AS value, count(*) AS n, sum(t) AS total
            FROM (SELECT node, t, unnest(attributes) AS a FROM rows_{level} WHERE node >= {1 << level}) GROUP BY ALL"""
        steps[f"sums_{level}"] = f"""
            SELECT node, place, attribute, list(value) OVER up AS chosen, sum(n) OVER up AS n, sum(n) OVER whole AS of_,
                (sum(total) OVER up)::DOUBLE AS x, (sum(total) OVER whole)::DOUBLE AS y
            FROM (SELECT *, CASE WHEN attribute = {ORDERED} THEN TRY_CAST(value AS DOUBLE) ELSE total / n END AS key FROM bins_{level})
            WINDOW whole AS (PARTITION BY node, attribute), up AS (PARTITION BY node, attribute ORDER BY key NULLS FIRST, value ROWS UNBOUNDED PRECEDING)"""
        steps[f"splits_{level}"] = f"""
            SELECT node, attribute, chosen FROM (SELECT *, x * x / n + (y - x) * (y - x) / (of_ - n) - y * y / of_ AS gain
                FROM sums_{level} WHERE n >= {LEAST} AND of_ - n >= {LEAST})
            WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, len(chosen)) = 1"""
        steps[f"rows_{level + 1}"] = f"""
            SELECT t, attributes, CASE WHEN attribute IS NULL THEN node ELSE 2 * node
                + CAST(NOT list_contains(chosen, list_filter(attributes, lambda a: a.attribute = s.attribute)[1].value) AS INTEGER) END AS node
            FROM rows_{level} LEFT JOIN splits_{level} s USING (node)"""
    steps["all_splits"] = " UNION ALL ".join(f"SELECT * FROM splits_{level}" for level in range(DEPTH))
    return steps


# --- control charts --------------------------------------------------------------------------------------------------

WARM_UP, SLACK, LIMIT, CUT = 60, 1.0, 8.0, 3.0


def charted() -> dict[str, str]:
    """Named steps: the state of every chart after each day, and the shift noticed on it."""
    deviation = "sqrt(squares / n)"
    off = f"CASE WHEN {deviation} > 0 THEN (x - mean) / {deviation} ELSE sign(x - mean) * {CUT} END"
    return {
        "daily": """
            SELECT product_category_name AS c, order_date AS day, avg(days_to_ship) AS days_to_ship, avg(is_late_shipment) AS late_share
            FROM gold_features_effective GROUP BY ALL""",
        "charts": " UNION ALL ".join(f"""
            SELECT c, '{m}' AS m, list(day ORDER BY day) AS days, list({m}::DOUBLE ORDER BY day) AS vs
            FROM daily WHERE {m} IS NOT NULL GROUP BY c""" for m in ("days_to_ship", "late_share")),
        "fold": f"""
            SELECT c, m, days, vs, -1 AS i, 0 AS n, 0::DOUBLE AS mean, 0::DOUBLE AS squares, 0::DOUBLE AS up, 0::DOUBLE AS down, -1 AS up_from, -1 AS down_from,
                NULL::INTEGER AS began, NULL::VARCHAR AS direction, NULL::DOUBLE AS level FROM charts
            UNION ALL
            SELECT c, m, days, vs, i + 1, CASE WHEN out_ THEN 1 ELSE n + 1 END, CASE WHEN out_ THEN x ELSE next_ END,
                CASE WHEN out_ THEN 0 ELSE squares + (x - mean) * (x - next_) END, CASE WHEN out_ THEN 0 ELSE u END, CASE WHEN out_ THEN 0 ELSE d END,
                CASE WHEN out_ THEN i + 1 WHEN u > 0 THEN up_from ELSE i + 2 END, CASE WHEN out_ THEN i + 1 WHEN d > 0 THEN down_from ELSE i + 2 END,
                CASE WHEN out_ THEN CASE WHEN u > {LIMIT} THEN up_from ELSE down_from END END,
                CASE WHEN out_ THEN CASE WHEN u > {LIMIT} THEN 'up' ELSE 'down' END END, CASE WHEN out_ THEN mean END
            FROM (SELECT *, u > {LIMIT} OR d > {LIMIT} AS out_, mean + (x - mean) / (n + 1) AS next_ FROM (
                SELECT *, greatest(0, up + z - {SLACK}) AS u, greatest(0, down - z - {SLACK}) AS d FROM (
                SELECT *, CASE WHEN n < {WARM_UP} THEN 0 ELSE greatest(-{CUT}, least({CUT}, {off})) END AS z FROM (
                SELECT *, vs[i + 2] AS x FROM fold WHERE i + 1 < len(vs)))))""",
    }


STATEMENTS = {
    "segments_kmeans": f"""
        SELECT customer_id, days_since_order, orders, total_sales, list_position(ds, list_min(ds)) - 1 AS segment,
            round(list_min(ds), 6) AS squared_distance
        FROM (SELECT *, {DISTANCES} AS ds FROM points, centres)""",
    "sales_regression": with_steps(regression("(SELECT 0 AS g, v FROM vectors)"), f"""
        SELECT unnest(['intercept', {', '.join(f"'{f}'" for f in FEATURES)}]) AS feature,
            round(unnest(list_prepend(intercept, slopes)), 4) AS coefficient, n AS sales FROM line"""),
    "sales_prediction": with_steps(regression("(SELECT 0 AS g, v FROM vectors)"), f"""
        SELECT order_number, product_key, sales_amount, round({EXPECTED}, 3) AS predicted FROM vectors, line"""),
    "regression_quality": with_steps(regression("(SELECT y.order_year AS g, v FROM (SELECT DISTINCT order_year FROM vectors) y JOIN vectors r ON r.order_year < y.order_year)"), f"""
        WITH scored AS (SELECT order_year, sales_amount, {EXPECTED} AS expected FROM vectors JOIN line ON g = order_year),
        errors AS (SELECT order_year, avg(sales_amount) AS average, round(avg(abs(expected - sales_amount)), 3) AS mean_error,
            round(1 - sum((expected - sales_amount) * (expected - sales_amount)) / nullif(var_pop(sales_amount) * count(*), 0), 6) AS explained
            FROM scored GROUP BY order_year),
        bins AS (SELECT order_year, floor(expected) AS bin, count(*) FILTER (sales_amount > average) AS p, count(*) FILTER (NOT sales_amount > average) AS q
            FROM scored JOIN errors USING (order_year) GROUP BY ALL),
        won AS (SELECT *, p * (coalesce(sum(q) OVER (PARTITION BY order_year ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + q / 2) AS w FROM bins)
        SELECT order_year, mean_error, explained, sum(p)::BIGINT AS positives, sum(q)::BIGINT AS negatives,
            round(sum(w) / nullif(sum(p)::DOUBLE * sum(q), 0), 6) AS rank_quality
        FROM won JOIN errors USING (order_year) GROUP BY order_year, mean_error, explained"""),
    "seasonal_forecast": seasonal("line_items", "items", "product_line"),
    "sales_forecast_quality": backtest("(SELECT 0 AS one, * FROM monthly)", "total_sales", "one"),
    "demand_forecast_quality": backtest("line_items", "items", "product_line"),
    "spend_tree": with_steps(grown(), f"""
        SELECT node, rows, CAST(round(CAST(CAST(total / rows AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE) AS average, attribute AS split_by,
            array_to_string(list_sort(chosen), ' | ') AS left_values
        FROM (SELECT node, count(*) AS rows, sum(t) AS total FROM (SELECT t, unnest(list_transform(range({DEPTH + 1}), lambda u: node >> u)) AS node FROM rows_{DEPTH})
              WHERE node > 0 GROUP BY node) LEFT JOIN all_splits USING (node)"""),
    "delivery_shifts": with_steps(charted(), """
        SELECT c AS product_category_name, m AS measure, days[began + 1] AS began, days[i + 1] AS noticed, direction, round(level, 6) AS level
        FROM fold WHERE direction IS NOT NULL"""),
    "factor_losses": with_steps(factors(), " UNION ALL ".join(factor_loss(r) for r in range(1, FACTOR_ROUNDS + 1))),
    "suggestions": with_steps(factors(), f"""
        SELECT c.customer_id, product_key, rank, round(suits, 6) AS suits FROM single_customer c LEFT JOIN (
            SELECT o.customer_id, r.product_key, r.rank, coalesce({product_sum('u.f', 'v.f')}, 0) AS suits
            FROM single_customer o JOIN region_ranks r USING (region) LEFT JOIN u_{FACTOR_ROUNDS} u ON u.k = o.customer_id
            LEFT JOIN v_{FACTOR_ROUNDS} v ON v.k = r.product_key
            WHERE r.rank <= {OFFERS} AND NOT EXISTS (SELECT 1 FROM bought b WHERE b.customer_id = o.customer_id AND b.product_key = r.product_key)
            QUALIFY row_number() OVER (PARTITION BY o.customer_id ORDER BY suits DESC, r.rank) = 1) USING (customer_id)"""),
}
