"""Mix sources to target weights by whole blocks, dealt to output shards by a splitting tree.

Every source's rows fall into about sqrt(rows) blocks by a hash, so the order of blocks is a random permutation and no
task ever holds a source: sums run over blocks first and over the rows of a single block last. A source's target is met
by whole passes over its blocks and a part of one more: blocks in order, then rows of the block where the rest ends, then
the one row that comes closest to what is still missing.

The units to deal out are (source, pass, block). At each node of a binary tree a random half of the units goes left; the
sources' counts in that half are exactly a multivariate-hypergeometric draw from the node's quotas, and the units
themselves are disjoint permuted blocks. A shard is put in order by the rows' own random keys. Only DataFrame operations.

Defined results: null text has size 0; null is a source of its own, last in order; a source without words has target 0
and takes nothing; repeated rows are rows of their own; an empty table gives an empty result; no row is taken more than
MOST_PASSES times; the same rows give the same mix on every run; columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from granary.session import stored, unused

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3
LEVELS = 4  # of the splitting tree: 16 shards
SEED = "mix-1"


def random_key(*parts: Column) -> Column:
    """60 random bits, the same in every engine."""
    digest = F.md5(F.concat_ws(":", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def sized(df: DataFrame, text: str, source: str, key: str) -> DataFrame:
    """Narrow rows to plan with. row tells repeated rows apart; it decides only between equal keys."""
    size = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    return df.select("_row", F.col(source).alias("source"), size.alias("size"), random_key(F.col(key)).alias("random"), F.col(key).alias("key"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """One row per source: rows, source_size, target. Sources fill up in the order in which they reach their limit."""
    sources = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())  # sources, not rows
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    weighed = sources.withColumn("weight", weight).withColumn("limit", MOST_PASSES * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up_to = by_limit.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    left = F.sum("source_size").over(everything) - F.sum("limit").over(up_to) + F.col("limit")
    weight_left = F.sum("weight").over(everything) - F.sum("weight").over(up_to) + F.col("weight")
    shares = weighed.withColumn("share", left / weight_left)
    share = F.first(F.when(F.col("limit") > F.col("share") * F.col("weight"), F.col("share")), ignorenulls=True).over(everything)
    target = F.least(F.col("limit").cast("double"), F.coalesce(share * F.col("weight"), F.col("limit").cast("double")))
    return shares.select("source", "n", "source_size", target.alias("target"))


def passes(sources: DataFrame) -> DataFrame:
    """How often a source is taken whole, the words still missing then, and the number of its blocks."""
    size = F.col("source_size")
    full = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(MOST_PASSES))).otherwise(0).cast("long")
    rest = F.when(F.col("full") < MOST_PASSES, F.greatest(F.col("target") - F.col("full") * size, F.lit(0.0))).otherwise(0.0)
    return sources.withColumn("full", full).withColumn("rest", rest).withColumn("blocks", F.ceil(F.sqrt("n")).cast("long"))


def _of_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with what is known of their source, and their block."""
    named = sources.withColumnRenamed("source", "its_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source").withColumn("block", F.pmod("random", "blocks"))


def cuts(rows: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks with their words, and sources with cut: the block in which the last, partial pass ends."""
    blocks = _of_source(rows, sources).groupBy("source", "block", "full", "rest", "blocks").agg(F.sum("size").alias("words"))
    up_to = F.sum("words").over(Window.partitionBy("source").orderBy("block"))
    after = blocks.withColumn("up_to", up_to)
    beyond = (F.col("up_to") > F.col("rest")) & (F.col("rest") > 0)
    ends = after.groupBy("source").agg(F.min(F.when(beyond, F.struct("block", (F.col("up_to") - F.col("words")).alias("before")))).alias("cut"))
    named = ends.withColumnRenamed("source", "cut_source")
    joined = sources.join(named, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    return blocks, joined.select("*", F.col("cut.block").alias("cut_block"), F.col("cut.before").alias("before")).drop("cut")


def picks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows of each source's cut block that the partial pass takes, and the row closest to the words then missing."""
    known = _of_source(rows, sources)
    order = Window.partitionBy("source").orderBy("random", "key", "_row")
    at_cut = known.where(F.col("block") == F.col("cut_block")).withColumn("up_to", F.col("before") + F.sum("size").over(order))
    inside = stored(at_cut.where(F.col("up_to") <= F.col("rest")).select("source", "_row", "up_to"), "picks")
    reached = inside.groupBy(F.col("source").alias("at_source")).agg(F.max("up_to").alias("reached"))
    free = known.where(F.col("block") >= F.col("cut_block")).join(inside.select("_row"), "_row", "left_anti")
    gap = F.col("rest") - F.coalesce(F.col("reached"), F.col("before"))
    missing = free.join(reached, F.col("source").eqNullSafe(F.col("at_source")), "left").withColumn("gap", gap)
    off = F.abs(F.col("size") - F.col("gap"))
    closest = missing.where(off < F.col("gap")).groupBy("source").agg(F.min(F.struct(off.alias("off"), "random", "key", "_row")).alias("best"))
    return inside.select("_row").union(closest.select("best._row"))


def dealt(blocks: DataFrame, sources: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per source and block: the shards of its passes, in order; the partial pass, if any, comes last."""
    named = sources.select(F.col("source").alias("of"), "cut_block")
    known = blocks.join(named, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    taken = F.col("full") + F.when(F.col("block") <= F.col("cut_block"), 1).otherwise(0)
    units = known.where(taken > 0).select("source", "block", F.explode(F.sequence(F.lit(1), taken)).alias("pass"), F.lit(0).alias("node"))
    for level in range(levels):
        key = random_key(F.lit(level), F.col("source").isNull(), F.col("source"), F.col("pass"), F.col("block"))
        node = Window.partitionBy("node")
        rank = F.row_number().over(node.orderBy(key, "source", "block", "pass"))
        right = (2 * rank > F.count("*").over(node)).cast("int")
        units = units.select("source", "block", "pass", (2 * F.col("node") + right).alias("node"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("pass", "node"))), lambda x: x["node"])
    return units.groupBy("source", "block").agg(in_order.alias("unit_shards"))


def parts(df: DataFrame, text: str, source: str, key: str, levels: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """What is taken of numbered rows: narrow rows, sources, the rows picked one by one, and the shards of every block."""
    rows = stored(sized(df, text, source, key), "sizes")
    sources = stored(passes(targets(rows)), "targets")
    blocks, with_cuts = cuts(rows, sources)
    sources = stored(with_cuts, "cuts")
    picked = picks(rows, sources).withColumn("picked", F.lit(True))
    shards = dealt(blocks, sources, levels).withColumnsRenamed({"source": "unit_source", "block": "unit_block"})
    return rows, sources, picked, shards


def placed(rows: DataFrame, sources: DataFrame, picked: DataFrame, shards: DataFrame) -> DataFrame:
    """rows (columns _row, source, size, random and others) with copies and shards, an entry for each copy."""
    known = _of_source(rows, sources).join(picked, "_row", "left")
    same = F.col("source").eqNullSafe(F.col("unit_source")) & (F.col("block") == F.col("unit_block"))
    partial = (F.col("block") < F.col("cut_block")) | F.coalesce(F.col("picked"), F.lit(False))
    copies = (F.col("full") + F.coalesce(partial, F.lit(False)).cast("int")).cast("int")
    own = F.coalesce(F.slice("unit_shards", 1, F.least(copies, F.size("unit_shards"))), F.array().cast("array<int>"))
    # a row picked from behind the cut goes where its block's last pass went, or else to the first shard
    filled = F.when(F.size(own) < copies, F.concat(own, F.array(F.coalesce(F.try_element_at(own, F.lit(-1)), F.lit(0))))).otherwise(own)
    found = F.when(F.col("size") > 0, filled).otherwise(F.array().cast("array<int>"))
    return known.join(shards, same, "left").select(*rows.columns, "source_size", "target", copies.alias("copies"), found.alias("shards"))


def planned(df: DataFrame, text: str, source: str, key: str, levels: int = LEVELS) -> DataFrame:
    """For each numbered row: size, source_size, target, taken, and shards with an entry for each copy."""
    found = placed(*parts(df, text, source, key, levels))
    return found.select("_row", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "shards")


OWN_NAMES = ("_row", "_copy", "_shard")


def numbered(df: DataFrame, outputs: set[str]) -> tuple[DataFrame, list[Column]]:
    """Rows with a stored number that tells equal ones apart, and the columns to return; names used here are set aside."""
    aside = {c: unused(f"own{c}", df.columns) for c in df.columns if c.lower() in OWN_NAMES}
    rows = stored(df.withColumnsRenamed(aside).withColumn("_row", F.monotonically_increasing_id()), "rows")
    return rows, [F.col(f"`{aside.get(c, c)}`").alias(c) for c in df.columns if c.lower() not in outputs]


def allotted(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """df with size, source_size, target, taken and shards (of 2 ** levels)."""
    outputs = ["size", "source_size", "target", "taken", "shards"]
    rows, others = numbered(df, set(outputs))
    plan = planned(rows, text, source, key, levels)
    found = rows.drop(*outputs).join(plan, "_row")
    return found.select(*others, *outputs)


def mixed(df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", levels: int = LEVELS) -> DataFrame:
    """The mix itself: df's columns with shard and order, a row for each copy, laid out by shard and in order within a shard.

    Partitions hold consecutive pieces of that order, so every file written from them is in order. Whole rows move once, for
    this: what is known of their blocks is written before, so that Spark knows whether it is few rows, which need no shuffle.
    """
    rows, others = numbered(df, {"shard", "order"})
    _, sources, picked, shards = parts(rows, text, source, key, levels)
    has_words = F.coalesce(F.col(text).rlike(WORD), F.lit(False)).cast("int")
    whole = rows.select("_row", F.col(source).alias("source"), has_words.alias("size"), random_key(F.col(key)).alias("random"),
                        F.col(key).alias("key"), F.struct(*others).alias("whole"))
    given = placed(whole, sources, stored(picked, "picked"), stored(shards, "shards"))
    copies = given.select("_row", "key", "whole", F.posexplode("shards").alias("copy", "shard"))
    place = ["shard", "order", "_row"]  # the number of the row keeps apart the rows of one key
    ordered = copies.withColumn("order", random_key(F.col("key"), F.col("copy"), F.lit("order")))
    return ordered.repartitionByRange(*place).sortWithinPartitions(*place).select("whole.*", "shard", "order")


def allotments(df: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, the words taken, and the shards of its copies."""
    plan = allotted(df.select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.array_join("shards", ",").alias("shards"))
