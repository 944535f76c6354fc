"""Best-record deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_record(df: DataFrame, key: str, preference: Sequence[Column]) -> DataFrame:
    """Keep the most preferred row of each key.

    Remaining columns break ties, so the result does not depend on row order. Spark plans the ``rank = 1`` filter as a
    group limit on both sides of the shuffle: a hot key sends one row per input task, not all its rows.
    """
    ties = [F.col(name).asc_nulls_last() for name in df.columns if name != key]
    order = Window.partitionBy(key).orderBy(*preference, *ties)
    return df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
