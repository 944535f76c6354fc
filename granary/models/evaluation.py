"""Evaluation of models: rolling-origin back-tests of monthly forecasts, and rank quality from a histogram of scores.

Back-tests cut every series at each month from the second full season on, make all forecasts from what comes before, and
compare them with the months that follow. A series is one array per key, its cuts are exploded from it, and all models of a
cut are expressions over the same prefix, so no model is fitted by a job of its own.

Defined results: months missing after the last are not forecast; a series too short for any cut adds nothing; ties in scores
count half, scores are compared as rounded to the bins of the histogram; without positive or without negative rows the rank
quality is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.models import season

LEAST_MONTHS = 2 * season.PERIOD


def line_ahead(prefix: Column, step: Column) -> Column:
    """A straight line through all values, continued. Months are numbered from 1."""
    n = F.size(prefix).cast("double")
    mean = season.total(prefix) / n
    weighted = season.total(F.transform(prefix, lambda v, i: v * (i + 1)))
    slope = (weighted - mean * n * (n + 1) / 2) / ((n * n * n - n) / 12)
    return mean + slope * (n + step - (n + 1) / 2)


# forecasts of a step from a prefix and the state that the seasonal model has after it
MODELS = {
    "last": lambda prefix, state, step: prefix[F.size(prefix) - 1],
    "mean": lambda prefix, state, step: season.total(prefix) / F.size(prefix),
    "line": lambda prefix, state, step: line_ahead(prefix, step),
    "year_ago": lambda prefix, state, step: prefix[F.size(prefix) - season.PERIOD + (step - 1) % season.PERIOD],
    "season": lambda prefix, state, step: season.ahead(state, step),
}


def forecasts(series: DataFrame, value: str, keys: list[str], horizon: int) -> DataFrame:
    """keys, cut (months before), model, step, actual, forecast."""
    arrays = season.as_arrays(series, value, keys).where(F.size("values") > LEAST_MONTHS)
    cuts = arrays.select(*keys, "values", F.explode(F.sequence(F.lit(LEAST_MONTHS), F.size("values") - 1)).alias("cut"))
    prefix = F.slice(F.col("values"), F.lit(1), F.col("cut"))
    fitted = cuts.select("*", prefix.alias("prefix"), season.best_state(prefix).alias("state"))
    steps = F.sequence(F.lit(1), F.least(F.lit(horizon), F.size("values") - F.col("cut")))
    ahead = F.transform(steps, lambda step: F.struct(
        step.alias("step"), F.get(F.col("values"), F.col("cut") + step - 1).alias("actual"),
        *[model(F.col("prefix"), F.col("state"), step).alias(name) for name, model in MODELS.items()]))
    rows = fitted.select(*keys, "cut", F.inline(ahead))
    return rows.unpivot([*keys, "cut", "step", "actual"], list(MODELS), "model", "forecast")


def backtest(series: DataFrame, value: str, keys: list[str], horizon: int) -> DataFrame:
    """Errors per model and step over all keys and cuts."""
    off = F.col("forecast") - F.col("actual")
    return forecasts(series, value, keys, horizon).groupBy("model", "step").agg(
        F.count(F.lit(1)).alias("forecasts"),
        F.round(F.avg(F.abs(off)), 4).alias("mean_error"),
        F.round(F.sqrt(F.avg(off * off)), 4).alias("root_mean_square_error"),
        F.round(100 * F.sum(F.abs(off)) / F.sum(F.abs("actual")), 4).alias("error_pct"),
    )


def score_bins(df: DataFrame, score: Column, positive: Column, width: float, keys: list[Column]) -> DataFrame:
    """keys, bin, positives, negatives: the histogram, which adds up over any split of the rows."""
    rows = df.select(*keys, F.floor(score / F.lit(width)).alias("bin"), positive.alias("positive")).where(F.col("bin").isNotNull() & F.col("positive").isNotNull())
    names = rows.columns[: len(keys)]
    return rows.groupBy(*names, "bin").agg(F.count_if("positive").alias("positives"), F.count_if(~F.col("positive")).alias("negatives"))


def rank_quality(bins: DataFrame, keys: list[str]) -> DataFrame:
    """Share of pairs of a positive and a negative row in which the positive has the higher score."""
    below = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    won = F.col("positives") * (F.coalesce(F.sum("negatives").over(below), F.lit(0)) + F.col("negatives") / 2)
    sums = bins.withColumn("won", won).groupBy(*keys).agg(
        F.sum("positives").alias("positives"), F.sum("negatives").alias("negatives"), F.sum("won").alias("won"))
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return sums.select(*keys, "positives", "negatives", F.round(F.col("won") / F.nullif(pairs, F.lit(0.0)), 6).alias("rank_quality"))
