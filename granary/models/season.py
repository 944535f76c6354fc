"""Monthly series with level, trend and a season of twelve months, folded over the ordered values of each key.

A series is one array per key: as long as the calendar, however many rows it was summed from. Every parameter set of a grid
is folded over the same array in the same pass, and the one with the smallest squared error of its one-step forecasts counts.

Defined results: ties go to the set that comes first in the grid; a series shorter than two seasons has no season and no
trend, and starts from its first value; a key without months has no row.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PERIOD = 12
GRID = tuple(product((0.1, 0.3, 0.6), (0.0, 0.1), (0.0, 0.2, 0.5)))  # shares of level, trend and season that are new


def let(value: Column, body) -> Column:
    """body of value, with value computed once."""
    return F.transform(F.array(value), body)[0]


def as_arrays(series: DataFrame, value: str, keys: list[str], month: str = "month") -> DataFrame:
    """keys, first month, last month, values in order of the months. A month must not repeat."""
    ordered = F.sort_array(F.collect_list(F.struct(month, F.col(value).cast("double").alias("value"))))
    return series.groupBy(*keys).agg(F.min(month).alias("first"), F.max(month).alias("last"), F.transform(ordered, lambda v: v["value"]).alias("values"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def start(values: Column) -> Column:
    """State before the first value: level, trend, the season ahead (its next month first), error so far."""
    seasonal = F.size(values) >= 2 * PERIOD
    year, next_year = F.slice(values, 1, PERIOD), F.slice(values, PERIOD + 1, PERIOD)
    mean = total(year) / PERIOD
    return F.struct(
        F.when(seasonal, mean).otherwise(F.get(values, F.lit(0))).alias("level"),
        F.when(seasonal, (total(next_year) / PERIOD - mean) / PERIOD).otherwise(0.0).alias("trend"),
        F.when(seasonal, let(mean, lambda m: F.transform(year, lambda v: v - m))).otherwise(F.array_repeat(F.lit(0.0), PERIOD)).alias("season"),
        F.lit(0.0).alias("error"),
    )


def step(state: Column, value: Column, parameters: Column, seasonal: Column) -> Column:
    a, b, c = (F.when(seasonal | (name == "a"), parameters[name]).otherwise(0.0) for name in "abc")
    now, ahead = state["season"][0], state["level"] + state["trend"]
    level = a * (value - now) + (1 - a) * ahead
    return F.struct(
        level.alias("level"),
        (b * (level - state["level"]) + (1 - b) * state["trend"]).alias("trend"),
        F.concat(F.slice(state["season"], 2, PERIOD - 1), F.array(c * (value - level) + (1 - c) * now)).alias("season"),
        (state["error"] + (value - ahead - now) * (value - ahead - now)).alias("error"),
    )


def best_state(values: Column) -> Column:
    """The state after all values with the parameters that forecast best, those being in fields a, b and c."""
    grid = F.array(*[F.struct(F.lit(i).alias("i"), *[F.lit(v).alias(n) for n, v in zip("abc", p)]) for i, p in enumerate(GRID)])
    seasonal = F.size(values) >= 2 * PERIOD

    def folded(first: Column) -> Column:
        def with_parameters(p: Column) -> Column:
            end = F.aggregate(values, first, lambda state, value: step(state, value, p, seasonal))
            return let(end, lambda e: F.struct(e["error"].alias("error"), p["i"].alias("i"), e["level"].alias("level"), e["trend"].alias("trend"),
                                              e["season"].alias("season"), *[p[n].alias(n) for n in "abc"]))

        return F.array_min(F.transform(grid, with_parameters))

    return let(start(values), folded)


def ahead(state: Column, steps: Column) -> Column:
    """Forecast for some months after the end."""
    return state["level"] + steps * state["trend"] + F.get(state["season"], ((steps - 1) % PERIOD).cast("int"))


def forecast(series: DataFrame, value: str, keys: list[str], horizon: int) -> DataFrame:
    """The next months of every series, with the parameters chosen."""
    models = as_arrays(series, value, keys).select(*keys, "last", best_state(F.col("values")).alias("state"))
    steps = models.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return steps.select(
        *keys, F.add_months("last", F.col("step")).alias("month"), F.round(ahead(F.col("state"), F.col("step")), 4).alias("forecast"),
        *[F.col(f"state.{n}").alias(name) for n, name in zip("abc", ("level_share", "trend_share", "season_share"))],
    )
