"""Validity intervals of versioned rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def version_intervals(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Set ``end`` to the day before the next version of the same key starts; NULL for the newest version.

    Versions follow each other by start date (NULL first), then by the remaining columns. Only the distinct start dates
    of a key are ordered in a window, a group bounded by the calendar; the rows themselves then look up their successor
    in a join whose hot partitions can be split. So no task ever holds all rows of a key.
    """
    rest = [name for name in df.columns if name not in (key, start, end)]
    copies = df.groupBy(key, start, *rest).agg(F.count(F.lit(1)).alias("_copies"))
    by_start = copies.groupBy(key, start).agg(F.max(F.struct(*rest, "_copies")).alias("_last"))
    chain = by_start.select(
        F.col(key).alias("_key"),
        F.col(start).alias("_start"),
        "_last",
        F.lead(start).over(Window.partitionBy(key).orderBy(F.col(start).asc_nulls_first())).alias("_next"),
    )

    # Rows of one start date succeed each other, so all but the last of them end the day before they begin.
    is_last = F.struct(*rest).eqNullSafe(F.struct(*[F.col(f"_last.{name}").alias(name) for name in rest]))
    several = F.col("_last._copies") > 1
    own_eve, next_eve = F.date_sub(F.col("_start"), 1), F.date_sub(F.col("_next"), 1)
    linked = (
        df.drop(end)
        .join(chain, F.col(key).eqNullSafe(F.col("_key")) & F.col(start).eqNullSafe(F.col("_start")))
        .where(~(is_last & several))
        .select(key, start, *rest, F.when(is_last, next_eve).otherwise(own_eve).alias(end))
    )

    # Equal copies of a last row cannot be told apart: one of them is followed by the next start date.
    rebuilt = repeated(chain.where(several), F.col("_last._copies")).select(
        F.col("_key").alias(key),
        F.col("_start").alias(start),
        *[F.col(f"_last.{name}") for name in rest],
        F.when(F.col("_copy") == 1, next_eve).otherwise(own_eve).alias(end),
    )
    return linked.unionByName(rebuilt).select(*df.columns)


def repeated(df: DataFrame, times: Column, chunk: int = 100_000) -> DataFrame:
    """Repeat each row and number its copies from 1; long runs are dealt out to all tasks in chunks."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = df.withColumn("_first", F.explode(F.sequence(F.lit(1).cast("bigint"), times, F.lit(chunk).cast("bigint"))))
    last = F.least(F.col("_first") + (chunk - 1), times)
    return chunks.repartition(tasks).withColumn("_copy", F.explode(F.sequence("_first", last))).drop("_first")
