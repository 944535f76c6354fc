"""Ridge regression from one aggregate: sums and cross products of features and target, which add up over any split.

Features are standardised, so one penalty (a share of the number of rows) holds for all; the coefficients returned are those
of the features as given. What is solved on the driver has the size of the features, whatever the number of rows.

Defined results: NULL counts as 0 (give an indicator of it as a feature); a constant feature gets 0; rows without target are
left out; without rows all is 0. Values should be centred near 0, as sums are kept in doubles.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PENALTY = 1e-3


@dataclass(frozen=True)
class Line:
    """target = intercept + sum of coefficient * feature."""

    rows: int
    intercept: float
    coefficients: dict[str, float]

    def predicted(self, features: dict[str, Column]) -> Column:
        total = F.lit(self.intercept)
        for name, slope in self.coefficients.items():
            total = total + F.lit(slope) * known(features[name])
        return total


def known(feature: Column) -> Column:
    return F.coalesce(feature.cast("double"), F.lit(0.0))


Moments = tuple[int, np.ndarray, np.ndarray]


def moments(df: DataFrame, features: dict[str, Column], target: Column) -> Moments:
    """(rows, sums, sums of cross products) of the features and, last, the target."""
    return added([*moments_by(df, F.lit(0), features, target).values()], len(features))


def moments_by(df: DataFrame, key: Column, features: dict[str, Column], target: Column) -> dict[object, Moments]:
    """The moments of each value of a key of few values, from one pass over the rows."""
    names = [f"x{i}" for i in range(len(features) + 1)]
    values = df.where(target.isNotNull()).select(key.alias("key"), *[known(c).alias(n) for c, n in zip([*features.values(), target], names)])
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    sums = values.groupBy("key").agg(F.count(F.lit(1)), *[F.sum(n) for n in names], *[F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs])
    out = {}
    for of, n, *totals in sums.collect():
        products = np.zeros((len(names), len(names)))
        for (i, j), total in zip(pairs, totals[len(names) :]):
            products[i, j] = products[j, i] = total
        out[of] = n, np.array(totals[: len(names)]), products
    return out


def added(parts: list[Moments], features: int) -> Moments:
    """The moments of all parts together."""
    size = features + 1
    return tuple(sum(part) for part in zip((0, np.zeros(size), np.zeros((size, size))), *parts))


def fitted(df: DataFrame, features: dict[str, Column], target: Column, penalty: float = PENALTY) -> Line:
    return line(moments(df, features, target), features, penalty)


def line(sums: Moments, features: dict[str, Column], penalty: float = PENALTY) -> Line:
    n = sums[0]
    mean, product = sums[1] / max(n, 1), sums[2] / max(n, 1)
    covariance = product - np.outer(mean, mean)
    variance = np.diag(covariance)[:-1]
    # what is left of a constant after rounding is no variance
    scale = np.sqrt(np.where(variance > 1e-12 * np.diag(product)[:-1], variance, 0))
    used = scale > 0
    slopes = np.zeros(len(features))
    if used.any():
        s = scale[used]
        inner = covariance[:-1, :-1][np.ix_(used, used)] / np.outer(s, s) + penalty * np.eye(len(s))
        slopes[used] = np.linalg.solve(inner, covariance[:-1, -1][used] / s) / s
    return Line(n, float(mean[-1] - slopes @ mean[:-1]), dict(zip(features, slopes.tolist())))
