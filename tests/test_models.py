"""Models against plain loops and numpy; the registered queries over them are checked against DuckDB in test_oracle."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.models import als, control, evaluation, kmeans, ridge, season, tree

FIRST = dt.date(2010, 1, 1)


def month(i):
    return dt.date(FIRST.year + i // 12, 1 + i % 12, 1)


# --- k-means ---------------------------------------------------------------------------------------------------------


def grouped_points(spark, seed=1):
    random = np.random.default_rng(seed)
    centres = [(0, 0), (1000, 0), (0, 4000), (1000, 4000)]
    rows = [(i, *(int(c + random.normal(0, 30)) for c in centres[i % 4])) for i in range(400)]
    return spark.createDataFrame(rows, "id long, a long, b long"), rows


def test_planted_clusters_are_found(spark):
    df, rows = grouped_points(spark)
    found, clusters = kmeans.clustered(df, "id", ["a", "b"], 4)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.cluster, set()).add(r.id % 4)
    assert sorted(map(sorted, groups.values())) == [[0], [1], [2], [3]]
    assert [c[1] > 2000 for c in clusters.centres] == [True, True, False, False]  # by the last feature, largest first


def test_rounds_match_numpy_from_the_same_seeds(spark):
    df, rows = grouped_points(spark, 5)
    x = np.array([r[1:] for r in rows], float)
    scale = kmeans.spread(df, ["a", "b"])
    assert np.allclose(scale, x.std(axis=0), rtol=1e-12)
    clusters = kmeans.Clusters(["a", "b"], scale, [(0.0, 0.0), (10.0, 0.0), (500.0, 500.0), (1e7, 1e7), (0.0, 2000.0)])
    centres = np.array(clusters.centres)
    for _ in range(6):
        near = (((x[:, None] - centres) / np.array(scale)) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[near == k].mean(axis=0) if (near == k).any() else c for k, c in enumerate(centres)])
        clusters = kmeans.moved(df, clusters)
        assert np.allclose(clusters.centres, centres, rtol=1e-12)
    assert clusters.centres[3] == (1e7, 1e7)  # lost all its points, keeps its centre


def test_clusters_of_odd_tables(spark):
    schema = "id long, a long, b long"
    same = spark.createDataFrame([(i, 5, 7) for i in range(10)] + [(99, None, 1)], schema)
    found, clusters = kmeans.clustered(same, "id", ["a", "b"], 3)
    assert clusters.centres == [(5.0, 7.0)]
    assert {(r.id, r.cluster) for r in found.collect()} == {(i, 0) for i in range(10)} | {(99, None)}
    empty, clusters = kmeans.clustered(spark.createDataFrame([], schema), "id", ["a", "b"], 3)
    assert clusters.centres == [] and empty.count() == 0 and "cluster" in empty.columns


def test_clusters_do_not_depend_on_the_split(spark):
    df, _ = grouped_points(spark, 9)
    results = [kmeans.clustered(part, "id", ["a", "b"], 5)[1].centres for part in (df.coalesce(1), df.repartition(7))]
    assert results[0] == results[1]


# --- regression ------------------------------------------------------------------------------------------------------


def test_regression_matches_least_squares(spark):
    random = np.random.default_rng(2)
    x = random.integers(-50, 50, (300, 3)).astype(float)
    y = 3 + x @ [2.0, -1.5, 0.25] + random.normal(0, 5, 300)
    df = spark.createDataFrame([(*map(float, row), float(t)) for row, t in zip(x, y)] + [(1.0, 2.0, 3.0, None)], "a double, b double, c double, y double")
    features = {n: F.col(n) for n in "abc"} | {"constant": F.lit(4)}
    line = ridge.fitted(df.repartition(5), features, F.col("y"), penalty=0.0)
    plain = np.linalg.lstsq(np.column_stack([np.ones(300), x]), y, rcond=None)[0]
    assert line.rows == 300 and line.coefficients["constant"] == 0
    assert np.allclose([line.intercept, *(line.coefficients[n] for n in "abc")], plain, rtol=1e-9)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    shrunk = np.linalg.solve(z.T @ z + 300 * 0.5 * np.eye(3), z.T @ (y - y.mean())) / x.std(axis=0)
    line = ridge.fitted(df, features, F.col("y"), penalty=0.5)
    assert np.allclose([line.coefficients[n] for n in "abc"], shrunk, rtol=1e-9)
    predicted = df.select(line.predicted(features).alias("p")).limit(300).toPandas()["p"]
    assert np.allclose(predicted, y.mean() + (x - x.mean(axis=0)) @ shrunk, rtol=1e-9)


def test_regression_of_no_rows(spark):
    line = ridge.fitted(spark.createDataFrame([], "a double, y double"), {"a": F.col("a")}, F.col("y"))
    assert (line.rows, line.intercept, line.coefficients) == (0, 0.0, {"a": 0.0})


# --- factors ---------------------------------------------------------------------------------------------------------


def test_factors_match_dense_numpy_and_the_loss_falls(spark):
    random = np.random.default_rng(4)
    amount = random.integers(1, 5, (30, 12)) * (random.random((30, 12)) < 0.3)
    amount[:, 0] = 2  # a product that everybody has bought
    rows = [(int(u), int(i), int(amount[u, i])) for u, i in zip(*np.nonzero(amount))] + [(None, 1, 3), (2, None, 3), (99, 99, 0)]
    df = spark.createDataFrame(rows, "u long, i long, n long")
    model = als.fitted(df, "u", "i", "n", with_losses=True)
    bought_items = spark.createDataFrame([(int(i),) for i in np.flatnonzero(amount.any(axis=0))], "i long")
    v = np.zeros((12, als.RANK))
    for r in als.start(bought_items, "i").collect():
        v[r.i] = r.factors
    confidence, preference = 1 + als.TRUST * amount, (amount > 0).astype(float)

    def solve(held, c, p):
        return np.array([np.linalg.solve((held.T * ci) @ held + als.PENALTY * np.eye(als.RANK), (held.T * ci) @ pi) for ci, pi in zip(c, p)])

    losses = []
    for _ in range(als.ROUNDS):
        u = solve(v, confidence, preference)
        v = solve(u, confidence.T, preference.T)
        losses.append((confidence * (preference - u @ v.T) ** 2).sum() + als.PENALTY * ((u**2).sum() + (v**2).sum()))
    assert np.allclose(model.losses, losses, rtol=1e-9) and all(a >= b for a, b in itertools.pairwise(model.losses))
    found = {r.i: r.factors for r in model.items.collect()}
    assert sorted(found) == sorted(np.flatnonzero(amount.any(axis=0))) and all(np.allclose(found[i], v[i], atol=1e-9) for i in found)
    assert {r.u for r in model.users.collect()} == set(range(30))


def test_losses_need_no_more_joins_than_the_factors(spark, monkeypatch):
    df = spark.createDataFrame([(u, i, 1 + (u * i) % 3) for u in range(6) for i in range(5) if (u + i) % 3], "u long, i long, n long")
    joins, join = [], type(df).join
    monkeypatch.setattr(type(df), "join", lambda self, *args, **kwargs: joins.append(1) or join(self, *args, **kwargs))
    als.fitted(df, "u", "i", "n", rounds=1, with_losses=True)
    assert len(joins) == 2  # one for each side


def test_moments_of_years_add_up(spark):
    df = spark.createDataFrame([(k % 3, float(k), float(k * k % 7)) for k in range(40)], "year int, x double, y double")
    parts = ridge.moments_by(df, F.col("year"), {"x": F.col("x")}, F.col("y"))
    assert sorted(parts) == [0, 1, 2]
    both = ridge.line(ridge.added([parts[0], parts[1]], 1), {"x": F.col("x")})
    plain = ridge.fitted(df.where("year < 2"), {"x": F.col("x")}, F.col("y"))
    assert both.rows == plain.rows and both.intercept == pytest.approx(plain.intercept)
    assert both.coefficients["x"] == pytest.approx(plain.coefficients["x"])
    assert ridge.line(ridge.added([], 1), {"x": F.col("x")}).coefficients == {"x": 0.0}


def test_factors_of_no_pairs(spark):
    model = als.fitted(spark.createDataFrame([], "u long, i long, n long"), "u", "i", "n", rounds=1, with_losses=True)
    assert model.users.count() == model.items.count() == 0 and model.losses == [0.0]


# --- seasons and back-tests ------------------------------------------------------------------------------------------


def plain_season(values):
    """(level, trend, season) after all values, by the best parameters."""
    best = None
    for i, (a, b, c) in enumerate(season.GRID):
        n, error = len(values), 0.0
        if n >= 24:
            level = sum(values[:12]) / 12
            trend, ring = (sum(values[12:24]) / 12 - level) / 12, [v - level for v in values[:12]]
        else:
            level, trend, ring, b, c = values[0], 0.0, [0.0] * 12, 0.0, 0.0
        for v in values:
            off = v - level - trend - ring[0]
            new = a * (v - ring[0]) + (1 - a) * (level + trend)
            trend, ring, level = b * (new - level) + (1 - b) * trend, [*ring[1:], c * (v - new) + (1 - c) * ring[0]], new
            error += off * off
        if best is None or (error, i) < best[0]:
            best = ((error, i), (level, trend, ring))
    return best[1]


def series_rows(spark, named):
    rows = [(k, month(i), float(v)) for k, values in named.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, month date, v double")


def test_seasonal_forecast_matches_a_plain_loop(spark):
    random = np.random.default_rng(6)
    wave = [100 + 3 * i + 40 * math.sin(2 * math.pi * i / 12) for i in range(60)]
    named = {"wave": wave, "noise": (random.normal(50, 9, 41)).tolist(), "short": random.normal(5, 1, 9).tolist(), "one": [7.0]}
    found = {(r.k, r.month): r.forecast for r in season.forecast(series_rows(spark, named), "v", ["k"], 3).collect()}
    for k, values in named.items():
        level, trend, ring = plain_season(values)
        for step in (1, 2, 3):
            assert found[k, month(len(values) + step - 1)] == pytest.approx(level + step * trend + ring[step - 1], abs=1e-4)
    assert found["wave", month(60)] == pytest.approx(100 + 180 + 40 * math.sin(0), abs=6)  # follows the season


def test_backtest_matches_a_plain_loop(spark):
    random = np.random.default_rng(8)
    named = {"a": random.normal(100, 20, 31).tolist(), "b": (50 + np.arange(27)).tolist(), "short": [1.0] * 24}
    errors = {}
    for values in named.values():
        for cut in range(24, len(values)):
            past, (level, trend, ring) = values[:cut], plain_season(values[:cut])
            slope, at = np.polyfit(np.arange(1, cut + 1), past, 1)
            for step in range(1, min(3, len(values) - cut) + 1):
                guesses = {"last": past[-1], "mean": sum(past) / cut, "line": at + slope * (cut + step), "year_ago": past[cut - 12 + step - 1],
                           "season": level + step * trend + ring[step - 1]}
                for model, guess in guesses.items():
                    errors.setdefault((model, step), []).append((guess - values[cut + step - 1], values[cut + step - 1]))
    rows = evaluation.backtest(series_rows(spark, named), "v", ["k"], 3).collect()
    assert len(rows) == len(errors) == 15
    for r in rows:
        off, actual = np.array(errors[r.model, r.step]).T
        assert r.forecasts == len(off)
        assert r.mean_error == pytest.approx(np.abs(off).mean(), abs=1e-4)
        assert r.root_mean_square_error == pytest.approx(np.sqrt((off**2).mean()), abs=1e-4)
        assert r.error_pct == pytest.approx(100 * np.abs(off).sum() / np.abs(actual).sum(), abs=1e-4)


def test_rank_quality_matches_all_pairs(spark):
    random = np.random.default_rng(3)
    rows = [("a" if i % 3 else "b", float(random.integers(0, 20)), bool(random.random() < 0.4)) for i in range(300)] + [("c", 1.0, True), ("a", None, True)]
    df = spark.createDataFrame(rows, "k string, score double, good boolean")
    found = {r.k: r for r in evaluation.rank_quality(evaluation.score_bins(df, F.col("score"), F.col("good"), 1.0, [F.col("k")]), ["k"]).collect()}
    for k in "ab":
        good, bad = ([s for n, s, g in rows if n == k and s is not None and g == want] for want in (True, False))
        won = sum((g > b) + (g == b) / 2 for g in good for b in bad)
        assert found[k].rank_quality == pytest.approx(won / len(good) / len(bad), abs=1e-6) and found[k].positives == len(good)
    assert found["c"].rank_quality is None


# --- tree ------------------------------------------------------------------------------------------------------------


def exhaustive(rows, attributes, least, ordered):
    """Gain of the best split of rows into two sets of values."""
    def cost(part):
        return sum(t for *_, t in part) ** 2 / len(part)

    best = 0.0
    for k, name in enumerate(attributes):
        values = sorted({r[k] for r in rows}, key=lambda v: (v is not None, v))
        subsets = [values[:i] for i in range(1, len(values))] if name in ordered else [
            c for n in range(1, len(values)) for c in itertools.combinations(values, n)]
        for chosen in subsets:
            left, right = ([r for r in rows if (r[k] in chosen) == want] for want in (True, False))
            if min(len(left), len(right)) >= least:
                best = max(best, cost(left) + cost(right) - cost(rows))
    return best


def test_splits_are_the_best_of_all(spark):
    random = np.random.default_rng(11)
    rows = []
    for _ in range(400):
        a, b, age = ["x", "y", "z", None][random.integers(4)], "pqrst"[random.integers(5)], int(random.integers(20, 30))
        rows.append((a, b, age, int(1000 * (a == "y") + 300 * (b in "qt") + 40 * (age > 25) + random.integers(0, 50))))
    df = spark.createDataFrame(rows, "a string, b string, age int, t long")
    splits = tree.fitted(df, "t", ["a", "b", "age"], ["age"], depth=3, least=5)
    parts = {1: rows}
    for node in sorted(splits):
        s, part = splits[node], parts[node]
        k = ["a", "b", "age"].index(s.attribute)
        text = lambda v: tree.NO_VALUE if v is None else str(v)
        parts[2 * node], parts[2 * node + 1] = ([r for r in part if (text(r[k]) in s.values) == want] for want in (True, False))
        gain = sum(sum(r[3] for r in p) ** 2 / len(p) for p in (parts[2 * node], parts[2 * node + 1])) - sum(r[3] for r in part) ** 2 / len(part)
        assert gain == pytest.approx(exhaustive(part, ["a", "b", "age"], 5, ["age"]), rel=1e-9)
    assert splits[1].attribute == "a" and {splits[2].attribute, splits[3].attribute} == {"b"}
    told = {r.node: r for r in tree.described(df, "t", ["a", "b", "age"], ["age"], 3, 5).collect()}
    assert all(told[n].rows == len(p) and told[n].average == pytest.approx(sum(r[3] for r in p) / len(p), abs=0.01) for n, p in parts.items())
    assert set(told) == set(parts) and told[1].split_by == "a"


def test_tree_of_equal_and_no_rows(spark):
    schema = "a string, t long"
    level = spark.createDataFrame([(v, 5) for v in "xyxyxy"], schema)
    assert [tuple(r) for r in tree.described(level, "t", ["a"], least=1).collect()] == [(1, 6, 5.0, None, None)]
    assert tree.described(spark.createDataFrame([], schema), "t", ["a"]).count() == 0


# --- control charts --------------------------------------------------------------------------------------------------


def plain_chart(values):
    out, s = [], None
    for i, x in enumerate(values):
        if s is None:
            s = {"n": 0, "mean": 0.0, "squares": 0.0, "up": 0.0, "down": 0.0, "uf": i, "df": i}
        z = 0.0
        if s["n"] >= control.WARM_UP:
            deviation = math.sqrt(s["squares"] / s["n"])
            z = (x - s["mean"]) / deviation if deviation > 0 else np.sign(x - s["mean"]) * control.CUT
            z = max(-control.CUT, min(control.CUT, z))
        up, down = max(0.0, s["up"] + z - control.SLACK), max(0.0, s["down"] - z - control.SLACK)
        if up > control.LIMIT or down > control.LIMIT:
            out.append((s["uf"] if up > control.LIMIT else s["df"], i, "up" if up > control.LIMIT else "down", round(s["mean"], 6)))
            s = {"n": 1, "mean": x, "squares": 0.0, "up": 0.0, "down": 0.0, "uf": i, "df": i}
            continue
        mean = s["mean"] + (x - s["mean"]) / (s["n"] + 1)
        s = {"n": s["n"] + 1, "mean": mean, "squares": s["squares"] + (x - s["mean"]) * (x - mean), "up": up, "down": down,
             "uf": s["uf"] if up > 0 else i + 1, "df": s["df"] if down > 0 else i + 1}
    return out


def test_planted_shifts_are_found_and_level_series_are_left_alone(spark):
    random = np.random.default_rng(7)
    named = {
        "up": [*random.normal(10, 1, 200), *random.normal(13, 1, 100)],
        "down twice": [*random.normal(10, 1, 150), *random.normal(6, 1, 150), *random.normal(2, 1, 150)],
        "level": random.normal(10, 1, 300).tolist(),
        "constant": [4.0] * 200,
        "constant then not": [4.0] * 100 + [5.0] * 20,
        "one bad day": [*random.normal(10, 1, 150), 500.0, *random.normal(10, 1, 150)],
        "short": [1.0, 2.0],
    }
    rows = [(k, FIRST + dt.timedelta(days=i), float(v)) for k, values in named.items() for i, v in enumerate(values)] + [("short", None, 1.0), ("up", FIRST, None)]
    df = spark.createDataFrame(rows, "k string, day date, v double")
    found = {}
    for r in control.shifts(df, "day", "v", ["k"]).collect():
        found.setdefault(r.k, []).append(((r.began - FIRST).days, (r.noticed - FIRST).days, r.direction, r.level))
    for k, values in named.items():
        assert [(*s[:3], pytest.approx(s[3], abs=1e-5)) for s in plain_chart(values)] == sorted(found.get(k, []))
    assert [s[0] for s in found["up"]] == [199]  # the day before was high by chance
    assert [s[0] for s in sorted(found["down twice"])] == [150, 300]
    assert found["constant then not"][0][:3] == (100, 104, "up")
    assert not {"level", "constant", "one bad day", "short"} & set(found)
