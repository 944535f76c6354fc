"""Date expressions. None of them reads the system clock: the run time is always an argument."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: earliest business date that is believed.
EARLIEST = dt.date(1990, 1, 1)


def moment(run_ts: dt.datetime) -> Column:
    """The run time as a timestamp literal in the session time zone."""
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp")


def with_dates(df: DataFrame, columns: Mapping[str, str], first: dt.date = dt.date(1000, 1, 1),
               last: dt.date = dt.date.max) -> DataFrame:
    """Read yyyymmdd numbers as dates: number column -> new date column.

    What is no date, or lies outside the given days, becomes NULL. Integer arithmetic takes a small fraction of the time
    of parsing digits as text. A candidate may run into another month (day 31 of a short one, day 0), so its day must be
    the day asked for. Two steps and a range check on the number keep generated code small.
    """
    low, high = (int(f"{day:%Y%m%d}") for day in (first, last))
    candidates = {name: candidate(F.col(number), low, high) for number, name in columns.items()}
    real = {name: F.when(F.dayofmonth(name) == F.col(number) % 100, F.col(name)) for number, name in columns.items()}
    return df.withColumns(candidates).withColumns(real)


def candidate(number: Column, low: int, high: int) -> Column:
    year, month, day = (number / 10000).cast("int"), (number / 100).cast("int") % 100, number % 100
    readable = number.between(low, high) & month.between(1, 12)
    return F.when(readable, F.date_add(F.make_date(year, month, F.lit(1)), day - 1))


def not_before(day: Column, floor: Column) -> Column:
    """The date unless it precedes a known floor date; an unknown floor rejects nothing."""
    return F.when(~F.coalesce(day < floor, F.lit(False)), day)


def not_future(day: Column, run_ts: dt.datetime) -> Column:
    """The date unless it lies after the run date."""
    return F.when(day <= F.lit(run_ts.date()), day)


def whole_years(since: Column, run_ts: dt.datetime) -> Column:
    """Completed years from a date to the run time."""
    return (F.months_between(moment(run_ts), since) / 12).cast("int")
