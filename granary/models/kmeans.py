"""k-means over integer features, one aggregate a round.

Distances are Euclidean in standard deviations of each feature. Centres are sums over counts of integers, so that they do
not depend on the order of rows, and a run ends at the same centres however the input is split.

Seeds come from oversampling: the first candidate is a random point, and every further round takes a fixed number of points,
weighted by their squared distance to the candidates so far (the smallest exponential variates at that rate win, which a
top-k finds in one pass). The candidates are weighed by the points nearest to them, and the heaviest and then the ones with
the largest weighted squared distance to those chosen become the seeds. Only candidates and centres reach the driver.

Defined results: ties go to the centre with the smaller number, and among points to the smaller key; a cluster that loses
all its points keeps its centre; with fewer different points than clusters there are fewer clusters, without points none;
a constant feature does not count; rows with a NULL feature are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.session import stored

SEED, OVERSAMPLING_ROUNDS, MOST_ROUNDS = 7, 3, 20

Point = tuple[float, ...]


@dataclass(frozen=True)
class Clusters:
    features: list[str]
    scale: Point
    centres: list[Point]

    def nearest(self) -> Column:
        """Struct of squared distance d and number k of the nearest centre."""
        return F.array_min(F.array(*[F.struct(self._distance(c).alias("d"), F.lit(k).alias("k")) for k, c in enumerate(self.centres)]))

    def _distance(self, centre: Point) -> Column:
        off = [(F.col(f"`{name}`") - F.lit(c)) / F.lit(s) for name, c, s in zip(self.features, centre, self.scale)]
        total = off[0] * off[0]
        for o in off[1:]:
            total = total + o * o
        return total


def exponential(key: Column, turn: int) -> Column:
    """A standard exponential variate that follows from the key and the turn."""
    hexadecimal = F.substring(F.md5(F.concat_ws(":", F.lit(f"{SEED}:{turn}"), key.cast("string")).cast("binary")), 1, 13)
    return -F.log((F.conv(hexadecimal, 16, 10).cast("double") + 1) / float(1 << 52))


def spread(points: DataFrame, features: list[str]) -> Point:
    """The standard deviation of each feature, 1 of a constant one."""
    exact = [F.col(f"`{name}`").cast("decimal(19,0)") for name in features]
    sums = points.agg(F.count(F.lit(1)), *map(F.sum, exact), *[F.sum(x * x) for x in exact]).first()
    n, first, second = sums[0], sums[1 : 1 + len(features)], sums[1 + len(features) :]
    if not n:
        return (1.0,) * len(features)
    squares = [n * int(b) - int(a) ** 2 for a, b in zip(first, second)]
    return tuple(math.sqrt(s) / n if s else 1.0 for s in squares)


def squared(a: Point, b: Point, scale: Point) -> float:
    return sum(((x - y) / s) * ((x - y) / s) for x, y, s in zip(a, b, scale))


def candidates(points: DataFrame, key: str, features: list[str], scale: Point, k: int) -> Clusters:
    """Points far from each other: one, and 2 k in each round."""
    taken = points.select(*features, exponential(F.col(key), 0).alias("late"), key).orderBy("late", key).limit(1).collect()
    chosen = Clusters(features, scale, [tuple(map(float, row[: len(features)])) for row in taken])
    for turn in range(1, OVERSAMPLING_ROUNDS + 1 if taken else 1):
        far = chosen.nearest()["d"]
        late = points.select(*features, key, far.alias("far")).where(F.col("far") > 0).withColumn("late", exponential(F.col(key), turn) / F.col("far"))
        taken = late.orderBy("late", key).limit(2 * k).collect()
        chosen = Clusters(features, scale, chosen.centres + [tuple(map(float, row[: len(features)])) for row in taken])
    return chosen


def seeds(found: Clusters, weights: dict[int, int], k: int) -> Clusters:
    """At most k of the candidates."""
    weight = [weights.get(j, 0) for j in range(len(found.centres))]
    gain, near, chosen = weight, [math.inf] * len(weight), []
    while len(chosen) < k and gain and max(gain) > 0:
        best = found.centres[gain.index(max(gain))]
        chosen.append(best)
        near = [min(d, squared(c, best, found.scale)) for d, c in zip(near, found.centres)]
        gain = [w * d for w, d in zip(weight, near)]
    return Clusters(found.features, found.scale, chosen)


def moved(points: DataFrame, clusters: Clusters) -> Clusters:
    """Every centre at the mean of the points nearest to it."""
    sums = points.groupBy(clusters.nearest()["k"].alias("k")).agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"`{name}`").cast("decimal(19,0)")) for name in clusters.features])
    means = {row["k"]: tuple(int(total) / row["n"] for total in row[2:]) for row in sums.collect()}
    return Clusters(clusters.features, clusters.scale, [means.get(j, c) for j, c in enumerate(clusters.centres)])


def fitted(points: DataFrame, key: str, features: list[str], k: int) -> Clusters:
    """Centres of at most k clusters. Points should be a written table: every round reads it."""
    points = points.na.drop(subset=features)
    scale = spread(points, features)
    found = candidates(points, key, features, scale, k)
    if not found.centres:
        return found
    weights = {row["k"]: row["count"] for row in points.groupBy(found.nearest()["k"].alias("k")).count().collect()}
    clusters = seeds(found, weights, k)
    for _ in range(MOST_ROUNDS):
        last, clusters = clusters, moved(points, clusters)
        if clusters == last:
            break
    return clusters


def clustered(points: DataFrame, key: str, features: list[str], k: int, name: str = "cluster") -> tuple[DataFrame, Clusters]:
    """points with the number of their cluster; the largest centre by the last feature, then those before it, is number 0."""
    points = stored(points, "points")
    clusters = fitted(points, key, features, k)
    clusters = Clusters(clusters.features, clusters.scale, sorted(clusters.centres, key=lambda c: c[::-1], reverse=True))
    if not clusters.centres:
        return points.withColumn(name, F.lit(None).cast("int")), clusters
    known = F.forall(F.array(*[F.col(f"`{f}`").isNotNull() for f in features]), lambda known: known)
    return points.withColumn(name, F.when(known, clusters.nearest()["k"])), clusters
