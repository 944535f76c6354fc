"""A Merkle manifest of a table: a hash tree per source, a tree over the sources, and a proof for every row.

Rows are ranked within their source and cut into aligned blocks of ARITY ** LEVELS. A block is one row that keeps each level
as one string, the hex digests one after the other. The parents of a level are the digests of its substrings of ARITY
digests, and the siblings of a node are the substrings that flank it in the substring of its parent. What is left of a block
is one node; these are the leaves of the next round, until every source has one node. The same is done once more with the
sources as leaves. Proofs are put together on the way back, block by block: each node gets the siblings above its block from
the round above, where every block is one row, so no step meets a hot key, and a source of any size is dealt out in blocks.

Ranks come from a range partitioning of narrow rows: the rank within a partition and source, and the rows of the source in
the partitions before. Rounds are written to shared storage; their number is the logarithm of the largest source.

Defined results: null fields are written as `-`, so they differ from empty ones; a null key comes first in its source, and a
null source first of all; rows with equal keys are ordered by their leaves, so that repeated rows change places only with
equals; a source of one row has its leaf for a root; texts of any length are one leaf; an empty table has no root and gives
an empty result; other columns are not part of the manifest and not returned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.quality import let
from granary.session import stored

ARITY, LEVELS = 3, 6  # children of a node, levels of a block
DIGEST = 64  # hex characters
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# a step of a proof: the siblings before and behind a node, each as hex digests one after the other
STEP = "struct<before:binary,behind:binary>"


def digest(data: Column) -> Column:
    """Lowercase hex sha256, as bytes, which are cut by position without being scanned."""
    return F.sha2(data, 256).cast("binary")


def leaf(fields: dict[str, Column]) -> Column:
    """Digest of fields, each as its length in bytes and its value."""
    def written(value: Column) -> Column:
        plain = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(plain).cast("string"), F.lit(":"), plain), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields.values())).cast("binary"), 256)


# --- ranks -----------------------------------------------------------------------------------------------------------


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add at, the rank from 0 within the group (null is one), and of, the rows of the group; equal rows in any order."""
    spread = stored(rows, name).withColumn("tie", F.monotonically_increasing_id())  # range bounds take a pass of their own
    laid = stored(spread.repartitionByRange(group, *order, "tie").withColumn("part", F.spark_partition_id()), name)
    counts = laid.groupBy(group, "part").agg(F.count(F.lit(1)).alias("n"))
    same = Window.partitionBy(group)
    before = F.sum("n").over(same.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col(group).alias("group_"), F.col("part").alias("part_"), F.coalesce(before, F.lit(0)).alias("offset"), F.sum("n").over(same).alias("of"))
    inside = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order, "tie"))
    placed = laid.withColumn("inside", inside).join(offsets, F.col(group).eqNullSafe(F.col("group_")) & (F.col("part") == F.col("part_")))
    return placed.withColumn("at", F.col("offset") + F.col("inside") - 1).drop("tie", "part", "group_", "part_", "offset", "inside")


# --- blocks ----------------------------------------------------------------------------------------------------------


def nodes(level: Column) -> Column:
    return (F.length(level) / DIGEST).cast("int")


def substring(level: Column, start: Column, n: Column | int) -> Column:
    """n digests of a level from a place counted from 0."""
    return F.substring(level, start * DIGEST + 1, (n if isinstance(n, Column) else F.lit(n)) * DIGEST)


def parents(level: Column, of: Column) -> Column:
    """The next level of a block; of is the number of nodes that the whole source has at this one."""
    last = F.ceil(nodes(level) / ARITY).cast("int") - 1
    hashed = F.transform(F.sequence(F.lit(0), last), lambda i: F.sha2(substring(level, i * ARITY, ARITY), 256))
    return F.when(of > 1, F.array_join(hashed, "").cast("binary")).otherwise(level)


def left_at(of: Column, level: int) -> Column:
    """Nodes of a source of so many leaves at a level."""
    return F.ceil(of / ARITY**level)


def levels(lowest: Column, of: Column, up: int = 0) -> Column:
    """An array of the LEVELS + 1 levels of a block, each computed once."""
    if up == LEVELS:
        return F.array(lowest)
    return let(parents(lowest, left_at(of, up)), lambda above: F.concat(F.array(lowest), levels(above, of, up + 1)))


def siblings(block: Column, of: Column, i: Column) -> Column:
    """Steps of the i-th leaf of a block: at every level that has more than one node, what flanks it below its parent."""
    def step(up: int) -> Column:
        place = F.floor(i / ARITY**up).cast("int")
        level, behind = block[up], place % ARITY
        return F.struct(substring(level, place - behind, behind).alias("before"), substring(level, place + 1, ARITY - 1 - behind).alias("behind"))

    steps = [F.when(left_at(of, up) > 1, step(up)) for up in range(LEVELS)]
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def blocks(rows: DataFrame, group: str, node: str, keep: list[str], name: str) -> DataFrame:
    """group, at (of the block), of, members (node, keep) in order, levels. Written, as two later steps read it."""
    size = ARITY**LEVELS
    member = F.struct("at", F.col(node).alias("node"), *keep)
    gathered = rows.groupBy(group, F.floor(F.col("at") / size).alias("block"), "of").agg(F.sort_array(F.collect_list(member)).alias("members"))
    lowest = F.array_join(F.transform("members", lambda m: m["node"]), "").cast("binary")
    return stored(gathered.select(group, F.col("block").alias("at"), "of", "members", let(lowest, lambda l: levels(l, F.col("of"))).alias("levels")), name)


def climbed(rows: DataFrame, group: str, node: str, keep: list[str], name: str) -> list[DataFrame]:
    """The blocks of all rounds, up to the one where every group is one block."""
    rounds = [blocks(rows, group, node, keep, name)]
    while (rounds[-1].agg(F.max("at")).first()[0] or 0) > 0:
        below = rounds[-1].select(group, "at", F.ceil(F.col("of") / ARITY**LEVELS).alias("of"), F.col("levels")[LEVELS].cast("string").alias("node"))
        rounds.append(blocks(below, group, "node", [], name))
    return rounds


def descended(rounds: list[DataFrame], group: str, above: DataFrame, carried: list[str]) -> DataFrame:
    """Members of the lowest round with their steps. above: group, steps of the group's root, and columns to carry down."""
    top = rounds[-1].join(above.withColumnRenamed(group, "group_"), F.col(group).eqNullSafe(F.col("group_"))).drop("group_")
    for k, lower in enumerate(reversed(rounds)):
        if k:
            top = lower.join(
                found.select(F.col(group).alias("group_"), F.col("at").alias("at_"), "steps", *carried),
                F.col(group).eqNullSafe(F.col("group_")) & (F.col("at") == F.col("at_")),
            ).drop("group_", "at_")
        levels_ = F.array(*[F.col("levels")[up] for up in range(LEVELS + 1)])  # taken out of the row once a block
        names = [f.name for f in lower.schema["members"].dataType.elementType.fields]
        proven = lambda block: F.transform("members", lambda m, i: F.struct(
            *[m[name].alias(name) for name in names], F.concat(siblings(block, F.col("of"), i), F.col("steps")).alias("steps")))
        found = top.select(group, *carried, F.inline(let(levels_, proven)))
    return found


# --- manifest and proofs ---------------------------------------------------------------------------------------------


def manifest(rows: DataFrame, group: str, order: list[str], node: str = "leaf") -> DataFrame:
    """Every row (its other columns kept) with the subroot of its group, the root, and steps, its proof."""
    keep = [c for c in rows.columns if c not in (group, node)]
    trees = climbed(ranked(rows, group, order, "leaves"), group, node, keep, "blocks")
    subroots = trees[-1].select(group, F.col("levels")[LEVELS].cast("string").alias("subroot"))
    whole = ranked(subroots.withColumn("all", F.lit(0)), "all", [group], "subroots")
    over = climbed(whole, "all", "subroot", [group], "sources")
    start = over[-1].select("all", F.array().cast(f"array<{STEP}>").alias("steps"), F.col("levels")[LEVELS].cast("string").alias("root"))
    sources = descended(over, "all", start, ["root"]).select(group, F.col("node").alias("subroot"), "steps", "root")
    return descended(trees, group, sources, ["subroot", "root"]).withColumnRenamed("node", node).drop("at")


def proof(steps: Column) -> Column:
    """All siblings one after the other, from the leaf to the root."""
    return F.aggregate(steps, F.lit("").cast("binary"), lambda all_, s: F.concat(all_, s["before"], s["behind"]))


def folded(steps: Column, node: Column) -> Column:
    """The root that a leaf and the siblings of a proof give."""
    up: Callable[[Column, Column], Column] = lambda below, s: digest(F.concat(s["before"], below, s["behind"]))
    return F.aggregate(steps, node.cast("binary"), up).cast("string")


def digests(df: DataFrame) -> DataFrame:
    """Per document: leaf, roots, proof, and whether the proof still holds when line feeds go from every other document."""
    fields = {name: F.col(name) for name in FIELDS}
    tampered = leaf({**fields, "text": F.translate("text", "\n", "")})
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    leaves = df.select("doc_id", "source", leaf(fields).alias("leaf"), F.when(touched, tampered).alias("tampered"))
    proven = manifest(leaves, "source", ["doc_id", "leaf"])
    after = folded(F.col("steps"), F.coalesce("tampered", "leaf"))
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof(F.col("steps")), 256).alias("proof_sha256"), after.alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
