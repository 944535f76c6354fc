"""Equi-joins that stay balanced when either side has hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import unused

PARTS = 64  # at most, of a key that the right side repeats often
ROWS = 1000  # of a key in one part


def left_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer equi-join that reads and shuffles the left side once. right_key is NULL in rows without partner.

    Spark splits hot partitions of the left side of an outer join, but not of the right one. So right rows are counted if
    equal, and those of a key with more than ROWS of them are dealt to several parts; a left row meets each part of its key.
    No part holds more than its share of a hot key, and the join may split the left side. The table of keys with several
    parts has at most a row for ROWS rows on the right, so every task gets it, and no left row moves to learn its parts.
    """
    taken = [*left.columns, *right.columns]
    part, parts, copies, key = (unused(name, taken) for name in ("part", "parts", "copies", "key"))
    others = [F.col(f"`{c}`") for c in right.columns if c != right_key]
    known = right.where(F.col(right_key).isNotNull())
    number = F.least(F.ceil(F.count(F.lit(1)) / ROWS), F.lit(PARTS)).cast("int")
    large = known.groupBy(F.col(right_key).alias(key)).agg(number.alias(parts)).where(F.col(parts) > 1)
    number_of = F.pmod(F.xxhash64(*others), F.coalesce(parts, F.lit(1))).cast("int")
    there = known.join(F.broadcast(large), F.col(right_key) == F.col(key)).groupBy(key).agg(F.collect_set(number_of).alias(parts))
    counted = known.groupBy(*right.columns).agg(F.count(F.lit(1)).alias(copies))
    rows = counted.join(F.broadcast(large), F.col(right_key) == F.col(key), "left").withColumn(part, number_of).drop(key, parts)
    told = left.join(F.broadcast(there), F.col(left_key) == there[key], "left")
    asked = told.select(*left.columns, F.explode_outer(parts).alias(f"{part}_"))
    met = asked.join(rows, (F.col(left_key) == F.col(right_key)) & (F.coalesce(f"{part}_", F.lit(0)) == F.col(part)), "left")
    every = F.sequence(F.lit(1), F.coalesce(F.col(copies), F.lit(1)))
    return met.select(*left.columns, *right.columns, F.explode(every).alias(copies)).drop(copies)


def unique_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left outer equi-join with a right side that has each key once by construction, so that only the left one can be hot."""
    return left.join(right, F.col(left_key) == F.col(right_key), "left")
