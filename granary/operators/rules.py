"""Data-quality rules: keep-and-count (warn) or remove (drop)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WARN, DROP = "warn", "drop"


@dataclass(frozen=True)
class Rule:
    """A named SQL condition rows should meet. A condition that evaluates to NULL counts as violated."""

    name: str
    condition: str
    action: str = WARN

    @property
    def met(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))

    @property
    def violations(self) -> Column:
        return F.count_if(~self.met).alias(self.name)


def enforce(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Remove the rows that violate a drop rule."""
    conditions = [rule.met for rule in rules if rule.action == DROP]
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule with its violation count, from a single aggregate. Takes the rows before enforcement."""
    counts = df.agg(*[rule.violations for rule in rules])
    lines = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"), F.col(rule.name).alias("violations")
        )
        for rule in rules
    ])
    return counts.select(F.inline(lines))
