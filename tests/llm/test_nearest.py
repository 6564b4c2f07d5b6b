"""Nearest vectors against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.llm import nearest as nn
from flightlake.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k=5, every=50):
    """Row by row; the sum runs in order of the dimensions, as the operator states."""
    usable = []
    for i, (vec_id, v, *_) in enumerate(rows):
        if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v):
            v = [float(np.float32(x)) for x in v]
            usable.append((i, vec_id, v))

    def inner(a, b):
        total = 0.0
        for x, y in zip(a, b):
            total += x * y
        return total

    out = []
    for i, q, v in usable:
        if q is None or q % every:
            continue
        scored = [
            (-(inner(v, w) / math.sqrt(inner(v, v) * inner(w, w))), c is None, c or 0, j, c)
            for j, c, w in usable
            if j != i and len(w) == len(v)
        ]
        out += [(q, rank + 1, c, -s) for rank, (s, _, _, _, c) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(frame, **options):
    rows = nn.nearest(frame, F.col("id") % 50 == 0, **options).collect()
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def awkward():
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], 1) for i in range(400)]
    rows += [(500 + i, rows[50][1], 1) for i in range(0, 120, 3)]
    rows += [(50, rows[50][1], 2), (None, rows[50][1], 2), (None, rows[3][1], 2)]
    rows += [(700 + i, [1e30 * x for x in rows[100 + i][1]], 3) for i in range(20)]
    rows += [(1000 + i, [rng.random() for _ in range(4)], 3) for i in range(0, 101, 50)]
    rows += [(1200, None, 1), (1250, [], 1), (1300, [0.0] * 16, 1), (1350, [float("nan")] * 16, 1)]
    rows += [(1400, [None] + [1.0] * 15, 1), (1450, [float("inf")] + [1.0] * 15, 1), (1500, [1.0, 2.0, 3.0], 1)]
    return rows


def test_nearest_is_brute_force(spark, awkward):
    frame = spark.createDataFrame(awkward, SCHEMA).repartition(5)
    expected = plain([tuple(r) for r in frame.collect()])
    assert {r[0] for r in expected} >= {0, 50, 1050} and 1500 not in {r[0] for r in expected}
    clashing = frame.withColumns({c: F.lit(1) for c in ("row", "id", "code", "scale", "floor", "score", "dims")})
    assert found(clashing) == expected


def test_blocks_and_long_vectors_change_nothing(spark, awkward, monkeypatch):
    frame = spark.createDataFrame(awkward, SCHEMA)
    expected = plain(awkward)
    for name, value in (("CANDIDATES", 37), ("QUERIES", 3), ("PAIRS", 11), ("EXACT_DIMS", 5), ("FIRST_SHARE", 2)):
        monkeypatch.setattr(nn, name, value)
    assert found(frame) == expected


def test_fewer_candidates_than_wanted(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (50, [1.0, 1.0], 1)], SCHEMA)
    assert found(few) == plain([tuple(r) for r in few.collect()])
    assert found(few.limit(0)) == []
    assert found(few.where("vec_id = 0")) == []


def test_bounds_hold_and_rule_most_pairs_out(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((600, 64)) @ np.diag(np.linspace(3, 0.2, 64))
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    rows = nn.coded(frame, "vec_id", "embedding").toArrow().sort_by("id")
    block = nn.Block(rows, 64)
    whole = (block.code @ block.code.T).astype(float) * block.scale[:, None] * block.scale
    slack = block.rest[:, None] * (1 + block.rest) + block.rest + nn.ROUNDING
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    assert (np.abs(whole - unit @ unit.T) <= slack).all()
    assert slack.mean() < 0.05


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    result = queries.op13_nearest_vectors(spark, sf_dir).collect()
    assert sorted((tuple(r) for r in result), key=repr) == plain(rows)
