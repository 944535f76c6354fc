"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its NEAREST nearest reference points, in order. Reference points are about 2 sqrt(n) of the
distinct vectors, MOST_PIVOTS at most, taken from a bounded sample (TRIED times as many, those with the smallest hashes)
so that no two are close; every vector is indexed. Inverted lists hold the vectors described by a pivot, per label. Two vectors are candidates if they share SHARED
pivots; then they share one of the first NEAREST - SHARED + 1 in any fixed order of pivots, so only those lists are kept,
and a pair is taken only in the list of the first pivot it shares. Candidates are verified by cosine in double precision.

Equal vectors are one row of the index. Lists are cut into blocks of BLOCK vectors and pairs of blocks are compared by
matrix products, so a hot list is spread over many tasks; a task hands on link counts and a spanning forest, not pairs.

Defined results: rows whose label is null, or whose vector is null, empty, zero or has a null or non-finite component,
have no links; vectors of different lengths have no links; repeated rows link as other vectors do; an empty table gives an
empty result; a component's id is its smallest vec_id; null vec_ids are counted but never give a component its id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.components import components
from granary.session import shipped, stored

LEAST_COSINE = 0.98
NEAREST, SHARED = 10, 4
FEWEST_PIVOTS, MOST_PIVOTS = 16, 4096
TRIED, APART = 4, 0.9  # sampled vectors for each pivot; cosine from which one of two pivots goes
BLOCK = 1024
PAIRS = 1 << 17  # pairs whose shared pivots are looked at together


def valid(vector: Column) -> Column:
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, number) & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes(rows: DataFrame) -> DataFrame:
    """Distinct vectors of a label: node, k1, k2, label, vector, copies, least_id."""
    return rows.groupBy("k1", "k2").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id"),
    ).withColumn("node", F.monotonically_increasing_id())


def unit(vectors: list) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares stay in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spread_out(points: np.ndarray, most: int) -> np.ndarray:
    """At most so many of the points, no two of them closer than APART: a dense group must not take most pivots."""
    chosen = points[:0]
    for point in points:
        if len(chosen) < most and (not len(chosen) or (chosen @ point).max() < APART):
            chosen = np.concatenate([chosen, point[None]])
    return chosen


def pivots(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Unit reference points by length of vector."""
    wanted = max(FEWEST_PIVOTS, min(MOST_PIVOTS, math.ceil(2 * math.sqrt(distinct.count()))))
    sample = distinct.orderBy("k1", "k2").limit(TRIED * wanted).select("vector").collect()
    by_length: dict[int, list] = {}
    for (vector,) in sample:
        by_length.setdefault(len(vector), []).append(vector)
    return {length: spread_out(unit(found), wanted) for length, found in by_length.items()}


def described(distinct: DataFrame, points: dict[int, np.ndarray]) -> DataFrame:
    """Add near: ordered numbers of the nearest pivots."""
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for vectors in batches:
            listed = vectors.to_pylist()
            out: list[list[int]] = [[] for _ in listed]
            for length in {len(v) for v in listed}:
                at = [i for i, v in enumerate(listed) if len(v) == length]
                own = points.get(length)
                if own is None:  # no sample of this length: its vectors share all pivots
                    for i in at:
                        out[i] = list(range(NEAREST))
                    continue
                missing = list(range(len(own), NEAREST))  # numbers that all vectors share
                for some in range(0, len(at), 4096):
                    part = at[some : some + 4096]
                    order = np.argsort(-(unit([listed[i] for i in part]) @ own.T), axis=1, kind="stable")[:, :NEAREST]
                    for i, near in zip(part, order):
                        out[i] = near.tolist() + missing
            yield pa.array(out, pa.list_(pa.int32()))

    return distinct.withColumn("near", F.arrow_udf(describe, "array<int>")(F.col("vector")))


def lists(index: DataFrame) -> DataFrame:
    """Inverted lists in pairs of blocks: first <= second; a vector of block b is in every pair that has b."""
    usual = F.array_sort(F.array_distinct("near"))
    kept = F.slice(usual, 1, NEAREST - SHARED + 1)
    entries = index.withColumn("length", F.size("vector")).select("*", F.explode(kept).alias("pivot"))
    keys = ["label", "length", "pivot"]
    sizes = index.withColumn("length", F.size("vector")).select("label", "length", F.explode(kept).alias("pivot")).groupBy(*keys).agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = entries.join(sizes.where("members > 1"), keys).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return pairs.select(*keys, F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "node", "copies", "vector", "near")


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many pivots rows of a and b share, and the smallest of them."""
    same = (a[:, :, None] == b[:, None, :]).any(axis=2)
    return same.sum(axis=1), np.where(same, a, np.iinfo(np.int32).max).min(axis=1)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links, as edges to the smallest node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(a.tolist(), b.tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(x, root(x)) for x in parent if root(x) != x]


def compare(table: pa.Table, least: float = LEAST_COSINE) -> pa.Table:
    """Links found in one pair of blocks: rows (a, null, links of a) and edges (a, b, null)."""
    pivot, first, second = (table[c][0].as_py() for c in ("pivot", "first", "second"))
    node, copies = table["node"].to_numpy(), table["copies"].to_numpy()
    block, near = table["block"].to_numpy(), np.array(table["near"].to_pylist(), np.int32)
    x = unit(table["vector"].to_pylist())
    columns = np.unique(near)
    has = np.zeros((len(node), len(columns)), np.float32)
    has[np.arange(len(node))[:, None], np.searchsorted(columns, near)] = 1
    links, edges = np.zeros(len(node), np.int64), []
    rows = np.flatnonzero(block == first)
    others = np.flatnonzero(block == second)
    for at in range(0, len(rows), BLOCK):
        for to in range(0, len(others), BLOCK):
            left, right = rows[at : at + BLOCK], others[to : to + BLOCK]
            candidate = has[left] @ has[right].T >= SHARED
            i, j = np.nonzero(candidate & (x[left] @ x[right].T >= least))
            i, j = left[i], right[j]
            if first == second:
                i, j = i[i < j], j[i < j]
            for some in range(0, len(i), PAIRS):
                p, q = i[some : some + PAIRS], j[some : some + PAIRS]
                mine = _shared(near[p], near[q])[1] == pivot
                p, q = p[mine], q[mine]
                links += (np.bincount(p, copies[q], len(node)) + np.bincount(q, copies[p], len(node))).astype(np.int64)
                edges += _forest(node[p], node[q])
    linked = np.flatnonzero(links)
    a = np.concatenate([node[linked], np.array([e[0] for e in edges], np.int64)])
    b = pa.array([None] * len(linked) + [e[1] for e in edges], pa.int64())
    n = pa.array([*links[linked].tolist(), *[None] * len(edges)], pa.int64())
    return pa.table({"a": pa.array(a, pa.int64()), "b": b, "n": n})


def links(index: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """a, b, n as compare gives them, over all lists."""
    shipped(index.sparkSession)
    keys = ["label", "length", "pivot", "first", "second"]
    return lists(index).groupBy(*keys).applyInArrow(lambda table: compare(table, least), "a long, b long, n long")


def linked(df: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    shipped(df.sparkSession)
    rows = df.select("vec_id", "label", F.col("embedding").alias("vector"))
    usable = F.col("label").isNotNull() & valid(F.col("vector"))
    keys = {"k1": F.xxhash64(F.lit(1), "label", "vector"), "k2": F.xxhash64(F.lit(2), "label", "vector")}
    good = rows.where(usable).withColumns(keys)
    distinct = stored(classes(good), "vectors")
    index = stored(described(distinct, pivots(distinct)), "index")
    found = stored(links(index, least), "links")
    counts = found.where("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    parts = components(found.where("b is not null"))
    known = distinct.select("k1", "k2", "node", "copies", "least_id").join(counts, "node", "left").join(parts, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    ids = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    result = known.join(ids, "component").select("k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    of_good = good.select("vec_id", "k1", "k2").join(result, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return of_good.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
