"""Factors of customers and products by alternating least squares over what was bought (implicit feedback).

Every pair of a customer and a product that was bought has preference 1 and a confidence that grows with the amount; all
other pairs have preference 0 and confidence 1. With the factors of one side held still, those of the other side solve one
small system each: the Gram matrix of all held factors, which all systems share, plus a sum over the pairs bought. These sums
are plain aggregates, added up before the shuffle, so a product that everybody bought, or a customer with a third of all
sales, reaches its last task as one partial sum from every other task. The systems are solved in batches in numpy.

Rounds are written to shared storage; the Gram matrices, which have the size of the factors, are all that the driver sees.

Defined results: pairs with NULL or without a positive amount are left out, amounts of repeated pairs must be summed before;
a side without any pair has no factors; without pairs there are none at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import shipped, stored

RANK, ROUNDS, TRUST, PENALTY, SEED = 6, 4, 2.0, 1.0, 7
PAIRS = [(i, j) for i in range(RANK) for j in range(i + 1)]


@dataclass(frozen=True)
class Model:
    """user, factors; item, factors; and the loss after every round."""

    users: DataFrame
    items: DataFrame
    losses: list[float]


def start(items: DataFrame, item: str) -> DataFrame:
    """Factors between 0 and 1 that follow from the key."""
    def one(k: int) -> Column:
        hexadecimal = F.substring(F.md5(F.concat_ws(":", F.lit(f"{SEED}:{k}"), F.col(item).cast("string")).cast("binary")), 1, 13)
        return F.conv(hexadecimal, 16, 10).cast("double") / float(1 << 52)

    return items.select(item, F.array(*map(one, range(RANK))).alias("factors"))


def gram(factors: DataFrame) -> np.ndarray:
    f = F.col("factors")
    sums = factors.agg(*[F.sum(f[i] * f[j]) for i, j in PAIRS]).first()
    out = np.zeros((RANK, RANK))
    for (i, j), value in zip(PAIRS, sums):
        out[i, j] = out[j, i] = value or 0.0
    return out


def solved(pairs: DataFrame, of: str, by: str, held: DataFrame, with_loss: bool = False) -> DataFrame:
    """The factors of one side, given those held of the other; with_loss adds bought, the loss over the pairs of a row.

    That is a sum of c (1 - p) ** 2 - p ** 2 with p the product of factors and c the confidence. It follows from the sums that
    the system is made of, so the pairs need not meet the factors of both sides once more.
    """
    shared, f = gram(held) + PENALTY * np.eye(RANK), F.col("factors")
    trust = TRUST * F.col("amount")
    sums = pairs.join(held, by).groupBy(of).agg(
        *[F.sum(trust * f[i] * f[j]).alias(f"a{i}_{j}") for i, j in PAIRS], *[F.sum((1 + trust) * f[i]).alias(f"b{i}") for i in range(RANK)],
        *([F.sum(1 + trust).alias("c")] if with_loss else []))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.zeros((batch.num_rows, RANK, RANK))
            for i, j in PAIRS:
                own[:, i, j] = own[:, j, i] = batch[f"a{i}_{j}"].to_numpy()
            inner = shared + own
            outer = np.stack([batch[f"b{i}"].to_numpy() for i in range(RANK)], axis=1)
            factors = np.linalg.solve(inner, outer[:, :, None])[:, :, 0]
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, batch.num_rows * RANK + 1, RANK), pa.int32()), pa.array(factors.ravel()))
            columns = [batch[of], rows]
            if with_loss:
                squares = np.einsum("ni,nij,nj->n", factors, own, factors)
                columns.append(pa.array(batch["c"].to_numpy() - 2 * (factors * outer).sum(axis=1) + squares))
            yield pa.RecordBatch.from_arrays(columns, kind.names)

    kind = T.StructType([T.StructField(of, pairs.schema[of].dataType), *T.StructType.fromDDL("factors array<double>")])
    if with_loss:
        kind = kind.add("bought", T.DoubleType())
    return stored(sums.mapInArrow(solve, kind), "factors")


def dot(a: Column, b: Column) -> Column:
    total = a[0] * b[0]
    for k in range(1, RANK):
        total = total + a[k] * b[k]
    return total


def loss(users: DataFrame, items: DataFrame) -> float:
    """Over all pairs: those bought are summed by item (column bought), the others come from the two Gram matrices."""
    bought = items.agg(F.sum("bought")).first()[0] or 0.0
    of_users, of_items = gram(users), gram(items)
    return float(bought + (of_users * of_items).sum() + PENALTY * (np.trace(of_users) + np.trace(of_items)))


def fitted(pairs: DataFrame, user: str, item: str, amount: str, rounds: int = ROUNDS, with_losses: bool = False) -> Model:
    """pairs: one row for each customer and product."""
    shipped(pairs.sparkSession)
    known = pairs.where(F.col(user).isNotNull() & F.col(item).isNotNull() & (F.col(amount) > 0))
    pairs = stored(known.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(amount).cast("double").alias("amount")), "pairs")
    items, losses = start(pairs.select("item").distinct(), "item"), []
    for _ in range(rounds):
        users = solved(pairs, "user", "item", items)
        items = solved(pairs, "item", "user", users, with_losses)
        if with_losses:
            losses.append(loss(users, items))
            items = items.drop("bought")
    return Model(users.withColumnRenamed("user", user), items.withColumnRenamed("item", item), losses)
