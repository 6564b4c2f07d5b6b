"""Toxic passages and line quality: exact parts, held-out accuracy, awkward rows."""

import itertools
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.llm import line_crf, queries, toxicity
from flightlake.llm.training import labelled, logistic
from tests.llm.fixtures import ROWS, documents, empty


def maximal(scores):
    """All maximal-scoring segments by their definition: best segment, then left and right of it."""
    best = max(
        ((sum(scores[i:j]), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        default=(0, 0, 0),
    )
    total, length, start = best[0], -best[1], -best[2]
    if total <= 0:
        return []
    left = maximal(scores[:start])
    right = [(a + start + length, b + start + length, s) for a, b, s in maximal(scores[start + length :])]
    return left + [(start, start + length - 1, total)] + right


@given(st.lists(st.integers(-6, 9).filter(bool), max_size=14))
@settings(max_examples=200, deadline=None)
def test_segments_are_the_maximal_ones(scores):
    # distinct fractions, so that no two sums tie
    scores = [x if x < 0 else x + (i + 1) * 0.001 for i, x in enumerate(scores)]
    scores = [-2.0 if x < 0 else x for x in scores]
    hits = [(i, x) for i, x in enumerate(scores) if x > 0]
    found = toxicity.segments(hits, 2.0)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in maximal(scores)]
    assert np.allclose([s for *_, s in found], [s for *_, s in maximal(scores)])


def test_many_lone_hits_cost_their_number():
    hits = [(3 * i, 3.0) for i in range(100_000)]
    began = time.perf_counter()
    assert toxicity.segments(hits, 2.0) == [(a, a, pytest.approx(3.0)) for a, _ in hits]
    assert time.perf_counter() - began < 10


def test_log_odds_favour_what_is_used_more():
    ratio, error = toxicity.log_odds(np.array([50.0, 5.0, 0.0]), np.array([0.0, 50.0, 50.0]), 1000.0, 10000.0)
    assert ratio[0] > 2 > ratio[1] > ratio[2] and ratio[0] > 2.5 * error[0]
    odds = toxicity.shrunk(ratio, error)
    assert odds[0] == ratio[0] - error[0] and (np.abs(odds) <= np.abs(ratio)).all()


@given(st.lists(st.integers(-6, 9), max_size=14))
@settings(max_examples=200, deadline=None)
def test_segments_with_scores_below_zero_are_the_maximal_ones(scores):
    scores = [x - 0.5 + (i + 1) * 0.001 for i, x in enumerate(scores)]
    hits = [(i, x) for i, x in enumerate(scores) if abs(x + 1.5) > 0.1]
    scores = [x if abs(x + 1.5) > 0.1 else -1.5 for x in scores]
    found = toxicity.segments(hits, 1.5)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in maximal(scores)]
    assert np.allclose([s for *_, s in found], [s for *_, s in maximal(scores)])


def test_texts_of_mild_words_are_told_apart(spark):
    rng = random.Random(8)
    mild, common = [f"mild{c}" for c in "abcdefghij"], [f"common{c}" for c in "abcdefghijklmnopqrst"]
    rows = []
    for i in range(3000):
        toxic = i % 4 == 0
        share = 0.5 if toxic else 0.12
        text = " ".join(rng.choice(mild if rng.random() < share else common) for _ in range(40))
        rows.append((i, text, int(toxic)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(frame, frame.select("doc_id", "toxic"))
    assert min(model.words.values()) < 0 < max(model.words.values()) and len(model.words) == 30
    found = toxicity.score(frame, model).join(frame.select("doc_id", "toxic"), "doc_id")
    held = [r for r in found.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.5) == r["toxic"] for r in held]) > 0.95


def test_training_rows_are_bounded(spark):
    repeated = spark.range(20_000).selectExpr("1L AS doc_id", "concat('text ', id % 50) AS text")
    others = spark.createDataFrame(
        [(i, "a\nb\nc") for i in range(2, 40)] + [(50, "\n" * 5000), (51, "x" * 500_000)], "doc_id long, text string"
    )
    docs = repeated.unionByName(others)
    labels = docs.select("doc_id").distinct().withColumn("toxic", F.lit(1))
    rows = labelled(docs, labels, "toxic", "doc_id", "text", 5000, most_lines=20_000).collect()
    folds = [i for i in [1, *range(2, 40)] if zlib.crc32(str(i).encode()) % 5]
    assert len(rows) == len(folds) and max(len(r["text"]) for r in rows) < 10
    assert labelled(docs, labels, "toxic", "doc_id", "text", 5000, most_lines=60).count() == 20


@pytest.fixture(scope="module")
def toxic_model(spark, sf_dir):
    return toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.QUERIES["op2_toxicity"](spark, folder).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    found = sum(r["predicted"] == 1 for r in rows if r["toxic"] == 1)
    assert right >= 0.97 * len(rows) and found >= 0.75 * sum(r["toxic"] for r in rows)
    assert sum(r["predicted"] for r in rows if r["toxic"] == 0) <= 0.01 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_toxic_passages_are_places_in_the_text(spark):
    model = toxicity.Model(words={"scum": 3.0, "moron": 2.5}, decay=2.0, rate=0.01, slope=3.0, intercept=-5.0)
    text = "İİ fine words. You SCUM, moron! " + "fine " * 50 + "scum"
    rows = spark.createDataFrame([(1, text), (2, "fine"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in toxicity.score(rows, model).collect()}
    assert [text[p["start"] : p["end"]] for p in found[1]["passages"]] == ["SCUM, moron", "scum"]
    assert found[1]["score"] > 0.9 > 0.1 > found[2]["score"] == found[3]["score"]


def test_awkward_rows_and_labels_for_both(spark, sf_dir, toxic_model):
    docs = documents(spark).withColumn("label", F.lit("x"))
    labels = spark.createDataFrame(
        [(0, 1, 0), (1, None, None), (None, 1, 1), (4, 0, 1), (4, 1, 1), (5, 0, 0), (7, 1, 0), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    for fitted, scorer in ((toxicity.fit(docs, labels), toxicity), (line_crf.fit(docs, labels), line_crf)):
        found = scorer.score(docs, fitted).collect()
        assert len(found) == len(ROWS) and all(0 <= r["score"] <= 1 for r in found)
        assert len({r["score"] for r in found if r["doc_id"] in (1, 2)}) == 1
        assert scorer.score(empty(spark), fitted).count() == 0
        nothing = scorer.fit(empty(spark), labels.limit(0))
        assert all(0 <= r["score"] <= 1 for r in scorer.score(docs, nothing).collect())
    assert toxicity.score(docs, toxic_model).count() == len(ROWS)
    drawn = labelled(docs, labels, "quality", "doc_id", "text", 2)
    assert drawn.count() <= 2


def sequences(length):
    return itertools.product((0, 1), repeat=length)


def test_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    moves = rng.standard_normal((2, 2))
    values = [rng.standard_normal(n) for n in (1, 4, 6)]
    scores, mask = line_crf.padded(values)
    marginal, expected, whole = line_crf.forward_backward(scores, mask, moves)
    pairs = np.zeros((2, 2))
    for k, bad in enumerate(values):
        weight = {
            y: np.exp(sum(bad[i] * y[i] for i in range(len(bad))) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            for y in sequences(len(bad))
        }
        z = sum(weight.values())
        assert np.isclose(np.log(z), whole[k])
        for i in range(len(bad)):
            assert np.isclose(sum(w for y, w in weight.items() if y[i]) / z, marginal[k, i])
        for y, w in weight.items():
            for a, b in zip(y, y[1:]):
                pairs[a, b] += w / z
    assert np.allclose(pairs, expected)


def test_held_out_quality_and_clean_documents_stay(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = queries.QUERIES["op9_line_quality"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    clean = [r for r in rows if r["quality"] == 1]
    assert sum(r["predicted"] for r in clean) >= 0.98 * len(clean)
    assert sum(r["predicted"] == 0 for r in rows if r["quality"] == 0) >= 0.7 * (len(rows) - len(clean))


def test_neighbouring_lines_count():
    own = np.arange(2 * line_crf.FEATURES, dtype=float).reshape(2, -1)
    wide = line_crf.with_neighbours(own)
    k = line_crf.FEATURES
    assert (wide[0, 2 * k : 3 * k] == own[1]).all() and (wide[1, k : 2 * k] == own[0]).all()
    assert (wide[0, k : 2 * k] == 0).all() and (wide[:, -1] == 1).all()


def test_calibration_recovers_a_curve():
    rng = np.random.default_rng(2)
    x = rng.standard_normal(20_000)
    y = (rng.random(len(x)) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    slope, intercept = logistic(x, y)
    assert abs(slope - 2) < 0.15 and abs(intercept + 1) < 0.1
    assert logistic(np.ones(3), np.ones(3))[0] == 0.0
