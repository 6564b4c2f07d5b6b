"""Reproducible shuffle into shards by a permutation that can be computed anywhere."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import fresh, numbered

ROUNDS = 6


def mix(values: np.ndarray, key: int) -> np.ndarray:
    """64 well-mixed bits for each value under a key."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sides(n: int) -> tuple[int, int]:
    """The two radices of the network: their product covers n and is below n + sqrt(n) + 1."""
    left = max(1, math.isqrt(max(0, n - 1)) + 1)
    return left, max(1, -(-n // left))


def network(numbers: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """One pass of the Feistel network on mixed radices; a bijection on all its cells."""
    a, b = sides(n)
    left, right = numbers // b, numbers % b
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        size, other = (b, left) if r % 2 else (a, right)
        step = (mix(other, seed * ROUNDS + r + 1) % np.uint64(size)).astype(np.int64)
        step = -step if back else step
        if r % 2:
            right = (right + step) % size
        else:
            left = (left + step) % size
    return left * b + right


def permute(numbers: np.ndarray, n: int, seed: int, back: bool = False) -> np.ndarray:
    """The permutation of 0 to n-1: cells beyond n walk on along their cycle until they fall inside.

    ``back`` gives its inverse, the row number at a shuffled position.
    """
    out = network(np.asarray(numbers, np.int64), n, seed, back)
    while (outside := out >= n).any():
        out[outside] = network(out[outside], n, seed, back)
    return out


def row_at(shard: int, slot: int, n: int, n_shards: int, seed: int) -> int:
    """The global row number that lies at a shard's slot; no table is needed."""
    return int(permute(np.array([slot * n_shards + shard]), n, seed, back=True)[0])


def shard_rows(rows: DataFrame, order: list[str], n_shards: int = 16, seed: int = 1) -> DataFrame:
    """Adds ``shard`` (0 to n_shards-1) and ``slot`` (gapless from 0 in each shard).

    Rows are numbered in ``order``; the seeded permutation of that number is
    dealt round robin, so shard sizes differ by one row at most and the same
    rows, seed and shard count give the same places at any partitioning. Nulls
    sort first; rows equal in ``order`` are interchangeable and share out their
    places in any way; an empty table stays empty. All columns of ``rows`` are
    kept: one named ``shard`` or ``slot`` is replaced.
    """
    rows = rows.drop("shard", "slot")
    number, place = fresh(rows, "_number"), fresh(rows, "_place")
    lined_up = numbered(rows, order, number)
    n = lined_up.count()

    @F.pandas_udf("long")
    def places(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), n, seed))

    return (
        lined_up.withColumn(place, places(number))
        .withColumn("shard", (F.col(place) % n_shards).cast("int"))
        .withColumn("slot", F.expr(f"`{place}` div {n_shards}"))
        .drop(number, place)
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, its rows in slot order within and across files."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
