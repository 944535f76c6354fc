"""Table profiles and checks of documented relationships."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union([
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        for name, df in tables.items()
    ])


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values, smallest and largest value as text."""
    return union([profile(name, df) for name, df in tables.items()])


def as_text(field: T.StructField) -> Column:
    """A text for each different value; zeros of either sign are one value."""
    value = F.col(f"`{field.name}`")
    return (value + F.lit(0) if isinstance(field.dataType, (T.FloatType, T.DoubleType)) else value).cast("string")


def profile(table_name: str, df: DataFrame) -> DataFrame:
    """One scan: rows become (column, value) pairs, which are counted before they are sent on; all figures follow from the counts."""
    fields = df.schema.fields
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("place"), as_text(f).alias("value")) for i, f in enumerate(fields)])))
    counts = pairs.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n"))

    def extreme(of, name: str) -> Column:
        typed = [of(F.when(F.col("place") == i, F.col("value").cast(f.dataType))).cast("string") for i, f in enumerate(fields)]
        return F.coalesce(*typed).alias(name)

    figures = counts.groupBy("place").agg(
        F.sum("n").alias("records"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
        F.count("value").alias("distinct_values"), extreme(F.min, "min_value"), extreme(F.max, "max_value"))
    rows = [(i, table_name, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)]
    columns = df.sparkSession.createDataFrame(rows, "place int, table_name string, column_name string, data_type string")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("records", "nulls", "distinct_values")]
    return columns.join(figures, "place", "left").select("table_name", "column_name", "data_type", *numbers, "min_value", "max_value")


def relationship_check(links: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Per link: rows of the referring table with a key, and how many of them find no row in the referred table.

    Both sides are reduced to their distinct keys before they meet, so hot keys do not matter.
    """
    return union([orphans(name, *link) for name, link in links.items()])


def orphans(link: str, child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    refs = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("_ref")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    known = parent.select(F.col(parent_key).alias("_ref")).distinct().withColumn("_known", F.lit(True))
    return refs.join(known, "_ref", "left").agg(
        F.lit(link).alias("link"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("referring_rows"),
        F.coalesce(F.sum(F.when(F.col("_known").isNull(), F.col("_rows"))), F.lit(0)).alias("orphan_rows"),
    )
