"""Numeric repair and derived measures."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import MISSING


def positive_or_zero(value: Column) -> Column:
    """The value, or 0 where it is NULL or below zero."""
    return F.greatest(F.coalesce(value, F.lit(0)), F.lit(0))


def cents(value: Column) -> Column:
    """Integer cents as DECIMAL(10,2)."""
    return (value / 100).cast("decimal(10,2)")


def completeness(columns: Sequence[str]) -> Column:
    """How many of the text columns carry a real value."""
    return reduce(operator.add, [indicator(F.col(name) != MISSING) for name in columns])


def indicator(condition: Column) -> Column:
    """1 where the condition holds, else 0."""
    return F.when(condition, 1).otherwise(0)


def unit_price(amount: Column, quantity: Column) -> Column:
    return F.round(amount / quantity, 2)


def margin_pct(price: Column, cost: Column) -> Column:
    """Margin over price in percent; NULL when there is no positive cost."""
    return F.when(cost > 0, F.round((price - cost) / price * 100, 2))


def profit(price: Column, cost: Column, quantity: Column) -> Column:
    """Unit margin times quantity; NULL when there is no positive cost."""
    return F.when(cost > 0, F.round((price - cost) * quantity, 2))
