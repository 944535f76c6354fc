"""Control charts: where a daily series leaves the level that it had before, by cumulative sums folded over its days.

Each day is compared with mean and deviation of the days since the last shift. What exceeds the slack is added up in both
directions; a sum over the limit is a shift, dated at the day on which that sum began to grow, and the chart starts anew on
the day it was noticed. A series is one array per key, as long as the calendar, so the fold is one expression per row.

Defined results: the first days of a chart only set its level; a day counts CUT deviations at most, so that no single day
is a shift; a series that never varied counts every change in full; days without value are left out before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARM_UP, SLACK, LIMIT, CUT = 60, 1.0, 8.0, 3.0
SHIFTS = "array<struct<began:int,noticed:int,direction:string,level:double>>"


def let(value: Column, body) -> Column:
    """body of value, with value computed once."""
    return F.transform(F.array(value), body)[0]


def fresh(place: Column, value: Column, shifts: Column) -> Column:
    """A chart that has seen one value; none before the first."""
    number = lambda v: F.lit(v).cast("double")
    return F.struct(
        place.cast("int").alias("place"), F.when(value.isNull(), 0).otherwise(1).alias("n"), F.coalesce(value, number(0)).alias("mean"), number(0).alias("squares"),
        number(0).alias("up"), number(0).alias("down"), place.cast("int").alias("up_from"), place.cast("int").alias("down_from"), shifts.alias("shifts"))


def surprise(s: Column, x: Column) -> Column:
    """How many deviations a day is off, CUT at most either way; 0 while the chart warms up."""
    deviation = F.sqrt(s["squares"] / s["n"])
    off = F.when(deviation > 0, (x - s["mean"]) / deviation).otherwise(F.signum(x - s["mean"]) * CUT)
    return F.when(s["n"] < WARM_UP, 0.0).otherwise(F.greatest(F.lit(-CUT), F.least(F.lit(CUT), off)))


def step(s: Column, x: Column) -> Column:
    def summed(z: Column) -> Column:
        return F.struct(F.greatest(F.lit(0.0), s["up"] + z - SLACK).alias("up"), F.greatest(F.lit(0.0), s["down"] - z - SLACK).alias("down"))

    def moved(t: Column) -> Column:
        place, n = s["place"] + 1, s["n"] + 1
        mean = s["mean"] + (x - s["mean"]) / n
        risen = t["up"] > LIMIT
        shift = F.struct(
            F.when(risen, s["up_from"]).otherwise(s["down_from"]).alias("began"), place.alias("noticed"),
            F.when(risen, "up").otherwise("down").alias("direction"), s["mean"].alias("level"))
        on = F.struct(
            place.alias("place"), n.alias("n"), mean.alias("mean"), (s["squares"] + (x - s["mean"]) * (x - mean)).alias("squares"),
            t["up"].alias("up"), t["down"].alias("down"),
            F.when(t["up"] > 0, s["up_from"]).otherwise(place + 1).alias("up_from"), F.when(t["down"] > 0, s["down_from"]).otherwise(place + 1).alias("down_from"),
            s["shifts"].alias("shifts"))
        return F.when(risen | (t["down"] > LIMIT), fresh(place, x, F.concat(s["shifts"], F.array(shift)))).otherwise(on)

    return let(let(surprise(s, x), summed), moved)


def shifts(daily: DataFrame, day: str, value: str, keys: list[str]) -> DataFrame:
    """keys, began, noticed (days), direction, level (the mean before)."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col(day).alias("day"), F.col(value).cast("double").alias("value"))))
    series = daily.where(F.col(value).isNotNull() & F.col(day).isNotNull()).groupBy(*keys).agg(ordered.alias("series"))
    start = fresh(F.lit(-1), F.lit(None).cast("double"), F.array().cast(SHIFTS))
    end = F.aggregate(F.col("series.value"), start, step)
    found = series.select(*keys, F.col("series.day").alias("days"), F.explode(end["shifts"]).alias("shift"))
    date = lambda place: F.get("days", F.col(f"shift.{place}")).alias(place)
    return found.select(*keys, date("began"), date("noticed"), F.col("shift.direction").alias("direction"), F.round("shift.level", 6).alias("level"))
