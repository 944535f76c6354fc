"""A regression tree over few-valued attributes, grown level by level from histograms.

A level takes one aggregate: count, sum and sum of squares of the target for each node, attribute and value, which add up
over any split of the rows. A split of an attribute is a prefix of its values ordered by their mean (no other subset can be
better), or by the values themselves where they are ordered, found by running sums over the histogram. What the driver sees
is one split for each node.

Defined results: NULL is a value like any other, the first of an ordered attribute; ties of a split go to the attribute named
first and to the shorter prefix, ties of a mean to the smaller value; a node is split only if that lowers the squared error
and leaves enough rows on both sides; rows without target are left out; without rows there is no node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import stored

DEPTH, LEAST_ROWS = 3, 20
NO_VALUE = "?"  # how NULL is written among the values of a split


@dataclass(frozen=True)
class Split:
    attribute: str
    values: tuple[str, ...]  # of the left child, 2 * node; the right one is 2 * node + 1


def written(attribute: str) -> Column:
    return F.coalesce(F.col(attribute).cast("string"), F.lit(NO_VALUE))


def node_of(splits: dict[int, Split], node: int = 1) -> Column:
    """The leaf of a row in the tree so far."""
    if node not in splits:
        return F.lit(node)
    split = splits[node]
    left = written(split.attribute).isin(list(split.values))
    return F.when(left, node_of(splits, 2 * node)).otherwise(node_of(splits, 2 * node + 1))


def histogram(rows: DataFrame, target: str, attributes: list[str], splits: dict[int, Split]) -> DataFrame:
    """node, place (of the attribute), attribute, value, n, total."""
    values = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(a).alias("attribute"), written(a).alias("value")) for i, a in enumerate(attributes)])
    each = rows.select(node_of(splits).alias("node"), F.col(target).alias("target"), F.inline(values))
    return each.groupBy("node", "place", "attribute", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("total"))


def best_splits(bins: DataFrame, ordered: list[str], least: int) -> DataFrame:
    """node, attribute, left: the split that lowers the squared error most."""
    key = F.when(F.col("attribute").isin(ordered), F.col("value").try_cast("double")).otherwise(F.col("total") / F.col("n"))
    within = Window.partitionBy("node", "attribute")
    prefix = within.orderBy(F.col("key").asc_nulls_first(), "value").rowsBetween(Window.unboundedPreceding, 0)
    sums = bins.withColumn("key", key).select(
        "node", "place", "attribute", F.collect_list("value").over(prefix).alias("left"), F.sum("n").over(prefix).alias("n"), F.sum("n").over(within).alias("of"),
        F.sum("total").over(prefix).cast("double").alias("total"), F.sum("total").over(within).cast("double").alias("whole"))
    rest, n, of = F.col("whole") - F.col("total"), F.col("n"), F.col("of")
    gain = F.col("total") * F.col("total") / n + rest * rest / (of - n) - F.col("whole") * F.col("whole") / of
    fair = sums.where((n >= least) & (of - n >= least)).withColumn("gain", gain).where(F.col("gain") > 0)
    # the largest gain, the attribute named first, the shortest prefix
    order = F.struct("gain", -F.col("place"), -F.size("left"))
    return fair.groupBy("node").agg(F.max_by(F.struct("attribute", "left"), order).alias("best")).select("node", "best.*")


def fitted(rows: DataFrame, target: str, attributes: list[str], ordered: list[str], depth: int = DEPTH, least: int = LEAST_ROWS) -> dict[int, Split]:
    """Splits by node; node 1 is the root. The target is an integer, rows should be a written table."""
    splits: dict[int, Split] = {}
    for level in range(depth):
        bins = histogram(rows, target, attributes, splits).where(F.col("node") >= 1 << level)
        found = best_splits(bins, ordered, least).collect()
        splits.update({r["node"]: Split(r["attribute"], tuple(r["left"])) for r in found})
        if not found:
            break
    return splits


def described(df: DataFrame, target: str, attributes: list[str], ordered: list[str] = [], depth: int = DEPTH, least: int = LEAST_ROWS) -> DataFrame:
    """All nodes: rows, average of the target, and by which attribute and values they are split."""
    rows = stored(df.where(F.col(target).isNotNull()).select(target, *attributes), "tree")
    splits = fitted(rows, target, attributes, ordered, depth, least)
    leaves = rows.groupBy(node_of(splits).alias("leaf")).agg(F.count(F.lit(1)).alias("n"), F.sum(target).alias("total"))
    above = F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda up: F.floor(F.col("leaf") / F.pow(F.lit(2), up)).cast("int"))
    nodes = leaves.select(F.explode(above).alias("node"), "n", "total").where("node > 0").groupBy("node").agg(F.sum("n").alias("rows"), F.sum("total").alias("total"))
    told = [(node, s.attribute, " | ".join(sorted(s.values))) for node, s in splits.items()]
    named = df.sparkSession.createDataFrame(told, "node int, split_by string, left_values string")
    average = F.round(F.col("total") / F.col("rows"), 2).alias("average")
    return nodes.join(F.broadcast(named), "node", "left").select("node", "rows", average, "split_by", "left_values")
