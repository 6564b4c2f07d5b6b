"""Mixing: targets by repeated sharing, seats by plain Sainte-Laguë, words by the runs themselves."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from flightlake.llm import queries
from flightlake.llm.mixing import apportion, mix_sources, mixed_blocks, mixed_texts, targets
from tests.llm.fixtures import documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reshared(totals, weights=(3, 1, 2)):
    """Targets by cutting at the ceiling and sharing the excess again, until none is above."""
    names = sorted((n for n in totals if n is not None), key=lambda n: [ord(c) for c in n]) + [None] * (None in totals)
    weight = {n: weights[i % 3] for i, n in enumerate(names)}
    left, free, out = 1.5 * sum(totals.values()), set(names), {}
    while free:
        level = left / sum(weight[n] for n in free)
        above = {n for n in free if level * weight[n] > 2 * totals[n]}
        if not above:
            return out | {n: level * weight[n] for n in free}
        for n in above:
            out[n] = 2.0 * totals[n]
            left -= out[n]
        free -= above
    return out


def seats_by_quotients(target, seats, most):
    held = dict.fromkeys(target, 0)
    order = {n: i for i, n in enumerate(target)}
    for _ in range(seats):
        free = [n for n in target if held[n] < most[n] and target[n] > 0]
        if not free:
            break
        held[max(free, key=lambda n: (target[n] / (2 * held[n] + 1), -order[n]))] += 1
    return held


@pytest.mark.parametrize(
    "totals",
    [{"a": 100, "b": 100, "c": 100}, {"a": 5, "b": 1000, "c": 30, None: 7}, {"x": 0, "y": 9}, {"é": 50, "z": 10, "Z": 400}],
)
def test_targets_end_where_resharing_ends(spark, totals):
    rows = spark.createDataFrame(list(totals.items()), "source string, total long")
    found = {r["source"]: r["target"] for r in targets(rows, (3, 1, 2), 1.5, 2.0).collect()}
    expected = reshared(totals)
    assert found.keys() == expected.keys()
    assert all(abs(found[n] - expected[n]) < 1e-6 for n in found)


@pytest.mark.parametrize("seats", [1, 2, 7, 40, 333])
def test_seats_are_those_of_the_highest_quotients(spark, seats):
    target = {1: 10.0, 2: 55.5, 3: 200.0, 4: 0.0, 5: 34.5, 6: 33.0}
    rows = [(n, t, sum(target.values()), 5, seats, 400, 1000) for n, t in target.items()]
    sources = spark.createDataFrame(
        rows, "number int, target double, budget double, n_sources long, seats long, blocks long, most long"
    )
    found = apportion(sources, 4).collect()
    for shard in range(4):
        upto = Counter()
        for r in found:
            if r["shard"] <= shard:
                assert r["quota"] >= 0
                upto[r["number"]] += r["quota"]
        expected = seats_by_quotients(target, seats * (shard + 1) // 4, dict.fromkeys(target, 1000))
        assert {n: upto[n] for n in target} == expected


def test_whole_table_comes_near_its_targets(spark, sf_dir):
    rows = queries.QUERIES["op7_mix_sources"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]])) and 0 <= r["taken"] <= 2 * r["size"]
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    expected = reshared(dict(size))
    for source, value in target.items():
        assert abs(value - expected[source]) < 1e-6
        assert abs(taken[source] - value) <= 0.005 * value
    assert all(r["source_size"] == size[r["source"]] for r in rows)


def test_reruns_agree_at_any_partitioning(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    one, many = (
        sorted((r["doc_id"], r["taken"], r["from_word"]) for r in mix_sources(docs.repartition(n)).docs.collect())
        for n in (1, 7)
    )
    assert one == many


def test_blocks_and_texts_hold_the_words_taken(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 120").withColumn("key", F.col("doc_id"))
    mix = mix_sources(docs, keep=("key",))
    taken = {r["key"]: r["taken"] for r in mix.docs.collect()}
    blocks, seats = Counter(), defaultdict(list)
    for r in mixed_blocks(mix).collect():
        blocks[r["key"]] += r["n_words"]
        seats[r["source"]].append((r["shard"], r["seat"]))
    assert blocks == Counter({k: n for k, n in taken.items() if n})
    quota = Counter()
    for r in mix.quotas.collect():
        quota[r["number"]] += r["quota"]
    numbers = {r["source"]: r["number"] for r in mix.sources.collect()}
    for source, held in seats.items():
        assert sorted({s for _, s in held}) == list(range(quota[numbers[source]]))
        assert [s for s, _ in sorted(held, key=lambda x: x[1])] == sorted(s for s, _ in held)
    original = {r["key"]: r["text"] for r in docs.collect()}
    words = Counter()
    for r in mixed_texts(docs, mix, "key", "text").collect():
        assert r["text"].strip() in original[r["key"]]
        words[r["key"]] += len(WORD.findall(r["text"]))
    assert words == blocks


def test_quotas_decide_the_words_of_each_shard(spark, sf_dir):
    rows = queries.QUERIES["op7_mix_sources"](spark, sf_dir).collect()
    assert all(len(r["shard_words"]) == 16 and sum(r["shard_words"]) == r["taken"] for r in rows)
    mix = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    words = {r["number"]: (r["source"], r["block_words"]) for r in mix.sources.collect()}
    held = defaultdict(Counter)
    for r in rows:
        held[r["source"]].update(dict(enumerate(r["shard_words"])))
    for r in mix.quotas.collect():
        source, length = words[r["number"]]
        # the last block of a source may be short, and is taken twice at most
        assert 0 <= r["quota"] * length - held[source][r["shard"]] <= 2 * length


def test_texts_keep_columns_that_clash(spark):
    docs = documents(spark).withColumn("key", F.monotonically_increasing_id())
    plain = sorted(r["text"] for r in mixed_texts(docs, mix_sources(docs, keep=("key",)), "key", "text").collect())
    names = ["_size", "size", "runs", "_runs", "_run", "number", "taken", "shard"]
    clashing = docs.withColumns({c: F.lit(c) for c in names})
    rows = mixed_texts(clashing, mix_sources(clashing, keep=("key",)), "key", "text").collect()
    assert sorted(r["text"] for r in rows) == plain
    assert all(r[c] == c for r in rows for c in names)


def test_awkward_rows(spark):
    clashing = documents(spark).withColumns({c: F.lit(1) for c in ("size", "place", "bucket", "target", "start")})
    rows = mix_sources(clashing).docs.collect()
    assert len(rows) == 10
    assert sum(r["size"] == 0 and r["taken"] == 0 for r in rows) == 4
    for source in ("b", None):
        own = [r for r in rows if r["source"] == source]
        assert sum(r["size"] for r in own) == own[0]["source_size"]
    nothing = documents(spark).where("text IS NULL")
    assert [(r["target"], r["taken"]) for r in mix_sources(nothing).docs.collect()] == [(0.0, 0), (0.0, 0)]
    assert mix_sources(empty(spark)).docs.count() == 0
