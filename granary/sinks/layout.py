"""Clustering on a space-filling curve: files that are narrow in every key, from one pass over the rows.

Keys are ranked by quantiles, and the bits of the ranks are interleaved, so rows that are near in all keys get near numbers
(cells) on the curve. Cells are dealt to files by their counts, in order, one that is more than a file to several. Quantiles and counts
come from narrow rows that hold the keys, such as the keys of the sales before they meet their dimensions, so that what is
laid out is computed once, for the write.

Defined results: NULL ranks before all values; equal rows may come to different files; keys are numbers, dates, booleans or
texts (texts are ranked by their first seven bytes); rows of a cell that the narrow rows did not hold are dealt by their hash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import unused

BITS = 6  # of the rank of a key: 2 ** (BITS * keys) cells at most, which bounds the table of cells
MOST_KEYS = 3
ACCURACY = 10_000


def ordinal(df: DataFrame, key: str) -> Column:
    """A number in the order of the key."""
    kind, value = df.schema[key].dataType, F.col(f"`{key}`")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    return value.cast("double")


def ordinals(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [ordinal(df, key) for key in keys]


def rank(value: Column, bounds: list[float]) -> Column:
    """How many bounds are not above a value, by bisection; 0 for NULL.

    The bounds are one array that every step looks into (NULL behind its end): a condition for each bound would make the
    method generated for a stage longer than the JVM compiles.
    """
    found, table = F.lit(0), F.lit([float(bound) for bound in bounds])
    for step in (1 << k for k in reversed(range(len(bounds).bit_length()))):
        found = found + F.when(value >= F.get(table, found + (step - 1)), step).otherwise(0)
    return found


def interleaved(ranks: list[Column]) -> Column:
    cell = F.lit(0)
    for bit in range(BITS):
        for k, r in enumerate(ranks):
            cell = cell + F.shiftleft(F.shiftright(r, bit).bitwiseAND(1), bit * len(ranks) + k)
    return cell


def quantiles(narrow: DataFrame, keys: Sequence[str]) -> list[list[float]]:
    shares = [i / (1 << BITS) for i in range(1, 1 << BITS)]
    found = narrow.agg(*[F.percentile_approx(o, shares, ACCURACY) for o in ordinals(narrow, keys)]).first()
    # a value that fills several quantiles gets a rank of its own
    heavy = [{math.nextafter(a, math.inf) for a, b in pairwise(values or []) if a == b} for values in found]
    return [sorted({*(values or []), *after}) for values, after in zip(found, heavy)]


def with_cell(df: DataFrame, keys: Sequence[str], bounds: list[list[float]], name: str) -> DataFrame:
    """df with the cell of each row. Ranks are columns of a step of their own, so that each is found once."""
    ranks = [f"{name}_{key}" for key in keys]
    ranked = df.select("*", *[rank(o, b).alias(r) for o, b, r in zip(ordinals(df, keys), bounds, ranks)])
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], interleaved([F.col(f"`{r}`") for r in ranks]).alias(name))


def dealt_cells(narrow: DataFrame, keys: Sequence[str], bounds: list[list[float]], files: int) -> DataFrame:
    """cell, its first file, and the number of files that share it. The window holds one row for each cell."""
    cells = with_cell(narrow, keys, bounds, unused("cell", narrow.columns))
    counts = cells.groupBy(F.col(cells.columns[-1]).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    up_to = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(Window.partitionBy())
    file = lambda row: F.floor(row * files / total).cast("int")
    placed = counts.select("cell", file(up_to - F.col("n")).alias("first"), file(up_to - 1).alias("last"), (F.col("n") * files > total).alias("heavy"))
    return placed.select("cell", "first", F.when(F.col("heavy"), F.col("last") - F.col("first") + 1).otherwise(1).alias("share"))


def clustered(df: DataFrame, keys: Sequence[str], narrow: DataFrame | None = None) -> DataFrame:
    """Lay rows out on the curve, in as many files as there are shuffle partitions. narrow: rows that hold the keys alone."""
    if not keys:
        return df
    if len(keys) > MOST_KEYS:
        raise ValueError(f"at most {MOST_KEYS} keys, got {list(keys)}")
    narrow = (df if narrow is None else narrow).select(*[F.col(f"`{key}`") for key in keys])
    files = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = quantiles(narrow, keys)
    cells = dealt_cells(narrow, keys, bounds, files)
    cell, first, share, file = (unused(name, df.columns) for name in ("cell", "first", "share", "file"))
    known = F.broadcast(cells.select(F.col("cell").alias(f"{cell}_"), F.col("first").alias(first), F.col("share").alias(share)))
    met = with_cell(df, keys, bounds, cell).join(known, F.col(cell) == F.col(f"{cell}_"), "left")
    # the same again when a lost task is repeated; columns in a struct are hashed in methods of their own
    spread = F.xxhash64(F.spark_partition_id(), F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    placed = F.coalesce(F.col(first) + F.pmod(spread, F.col(share)), F.pmod(spread, F.lit(files))).cast("int")
    laid = met.withColumn(file, placed).repartitionById(files, file).sortWithinPartitions(cell, *[F.col(f"`{key}`") for key in keys])
    return laid.select(*[F.col(f"`{c}`") for c in df.columns])
