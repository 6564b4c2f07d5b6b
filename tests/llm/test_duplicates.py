"""SimHash and vector near-duplicates against brute force, and the components below both."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from flightlake.llm import common, queries, vector_dedup
from flightlake.llm.components import components
from flightlake.llm.simhash import deduplicated, fingerprint, links, near_duplicates
from tests.llm.fixtures import ROWS, documents, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_fingerprint(text, width=4):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def least_reachable(ids, pairs):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_fingerprints_are_exact():
    rng = random.Random(2)
    texts = [r[1] or "" for r in ROWS if r[0] != 4]
    texts += [" ".join(rng.choice("aA é ß ÀB 日").strip() for _ in range(n)) for n in (1, 3, 4, 5, 50)]
    for text in texts:
        assert fingerprint(text.encode(), 4) % 2**64 == plain_fingerprint(text)
    long = " ".join(f"w{i % 7919}" for i in range(40_000))
    assert fingerprint(long.encode(), 4) % 2**64 == plain_fingerprint(long)


def test_cells_are_never_broadcast(spark):
    """Each fingerprint has dozens of cells; Spark sizes them like the fingerprints."""
    found = links(spark.range(2000).selectExpr("xxhash64(id) fp"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_a_table_with_more_rows_than_are_broadcast_is_shuffled(spark, monkeypatch):
    """Small as its files may be; the rows are the same."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", 10)
    kept = common.without_rows(spark.range(100).toDF("k"), spark.range(0, 100, 3).toDF("k"), "k")
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["k"] for r in kept.collect()) == [k for k in range(100) if k % 3]


def test_links_are_all_close_pairs_once(spark):
    rng = random.Random(4)
    points = {rng.getrandbits(64) for _ in range(300)}
    for p in list(points)[:150]:
        for flips in (1, 2, 3, 4, 4, 5):
            points.add(p ^ sum(1 << b for b in rng.sample(range(64), flips)))
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    rows = spark.createDataFrame([(p,) for p in signed], "fp long")
    for bits, agreeing in ((4, 3), (3, 2), (0, 1)):
        found = [(r["a"], r["b"]) for r in links(rows, bits, agreeing).collect()]
        expected = {
            (min(a, b), max(a, b))
            for i, a in enumerate(signed)
            for b in signed[:i]
            if ((a ^ b) % 2**64).bit_count() <= bits
        }
        assert len(found) == len(set(found)) and set(found) == expected
    with pytest.raises(ValueError):
        links(rows, 30, 3)


def test_components_of_a_long_path_and_a_hub(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    path = list(zip(order, order[1:]))
    hub = [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    found = components(spark.createDataFrame(path + hub + path[:5], "a long, b long"))
    roots = {r["node"]: r["root"] for r in found.collect()}
    assert roots == {i: 0 for i in range(200)} | {i: 1000 for i in range(1000, 1200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    fp = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs}
    pairs = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4]
    expected = least_reachable(fp, pairs)
    found = queries.QUERIES["op4_simhash"](spark, sf_dir).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in found} == fp
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(len(r["fingerprint"]) == 16 for r in found) and pairs


def test_awkward_documents(spark):
    rows = documents(spark).withColumns({"fp": F.lit("x"), "_row": F.lit(1)})
    found = near_duplicates(rows).collect()
    assert len(found) == len(ROWS)
    same = {r["component_id"] for r in found if r["fp"] == 0}
    assert same == {1}
    kept = deduplicated(rows)
    assert kept.columns == rows.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 4, 7]
    nameless = spark.createDataFrame([(None, "a b"), (None, "a b")], "doc_id long, text string")
    assert [r["component_id"] for r in near_duplicates(nameless).collect()] == [None, None]
    assert deduplicated(nameless).count() == 1
    assert near_duplicates(empty(spark)).count() == deduplicated(empty(spark)).count() == 0


def brute_links(rows, threshold=0.93):
    usable = [
        (i, label, np.array(v, float) / np.abs(v).max())
        for i, v, label in rows
        if label is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    return [
        (a, b)
        for i, (a, la, va) in enumerate(usable)
        for b, lb, vb in usable[:i]
        if la == lb and len(va) == len(vb) and va @ vb / np.linalg.norm(va) / np.linalg.norm(vb) >= threshold
    ]


def check_vectors(spark, rows):
    found = vector_dedup.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("class", F.lit("x"))
    ).collect()
    pairs = brute_links(rows)
    degree = dict.fromkeys([r[0] for r in rows], 0)
    for a, b in pairs:
        degree[a] += 1
        degree[b] += 1
    assert len(found) == len(rows)
    assert Counter((r["vec_id"], r["n_links"]) for r in found) == Counter(degree.items())
    roots = least_reachable(degree, pairs)
    assert {r["vec_id"]: r["component_id"] for r in found} == roots
    assert all(r["kept"] == (roots[r["vec_id"]] == r["vec_id"]) for r in found)
    return found


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    rows += [(100 + i, (v * 3).tolist(), i % 3) for i, v in enumerate(base[:10])]
    rows += [(200 + i, v.tolist(), i % 3) for i, v in enumerate(base[:10])]
    rows += [(300, None, 1), (301, [], 1), (302, [0.0] * 16, 1), (303, [None] + [1.0] * 15, 1)]
    rows += [(304, [float("nan")] * 16, 1), (305, [float("inf")] * 16, 1), (306, base[0].tolist(), None)]
    rows += [(307, base[1][:8].tolist(), 1), (308, base[1][:8].tolist(), 1), (309, [1e300] * 16, 2), (310, [1e-300] * 16, 2)]
    check_vectors(spark, rows)


def test_null_and_repeated_ids_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>, label int"
    rows = [(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (None, None, None)]
    found = vector_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    told = sorted((str(r["vec_id"]), r["n_links"], r["component_id"] or 0, r["kept"]) for r in found)
    assert told == [("4", 2, 4, True), ("4", 2, 4, True), ("None", 0, 0, False), ("None", 2, 4, False)]
    assert vector_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + 0.12 * rng.standard_normal(32)).tolist(), 0) for i in range(150)]
    rows += [(1000 + i, rng.standard_normal(32).tolist(), 0) for i in range(100)]
    check_vectors(spark, rows)


def test_recall_right_at_the_threshold(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        cosine = 0.9301 + 0.03 * rng.random()
        rows += [(2 * i, a.tolist(), 0), (2 * i + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).tolist(), 0)]
    check_vectors(spark, rows)


def close_pairs(rng, n, dims, least=0.93001, most=0.96):
    """Unrelated pairs, each with a cosine from ``least`` to ``most``."""
    a, b = rng.standard_normal((2, n, dims))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    cosine = rng.uniform(least, most, n)[:, None]
    return np.stack([a, cosine * a + np.sqrt(1 - cosine**2) * b], 1).reshape(2 * n, dims)


def test_no_link_is_lost(spark):
    vectors = close_pairs(np.random.default_rng(11), 4000, 24, most=0.9303)
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    degree = (unit @ unit.T >= 0.93).sum(1) - 1
    assert degree.min() >= 1
    found = vector_dedup.near_duplicates(rows).collect()
    assert {r["vec_id"]: r["n_links"] for r in found} == dict(enumerate(degree.tolist()))


@pytest.mark.parametrize("dims", [2, 3, 64])
def test_no_link_is_lost_between_portions(spark, monkeypatch, dims):
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", 32)
    monkeypatch.setattr(vector_dedup, "TILE_ROWS", 8)
    vectors = close_pairs(np.random.default_rng(dims), 150, dims)
    check_vectors(spark, [(i, v.tolist(), i // 2 % 2) for i, v in enumerate(vectors)])


def portion(vectors, seed=1, first=0):
    unit = vector_dedup.scaled(vectors)
    code, length, factor = vector_dedup.encode(unit, vector_dedup.rotation(vectors.shape[1], seed))
    rows = {"class": range(first, first + len(unit)), "members": [1] * len(unit), "length": length, "factor": factor}
    return vector_dedup.Portion(pa.table({**rows, "code": [c.tobytes() for c in code]}), vectors.shape[1])


def test_intervals_hold_and_leave_few_pairs_open():
    rng = np.random.default_rng(12)
    for dims in (1, 2, 8, 64, 256, 1500):
        vectors = close_pairs(rng, 150, dims, 0.9, 0.96) if dims > 1 else rng.choice([-1.0, 1.0], (50, 1))
        unit, held = vector_dedup.scaled(vectors), portion(vectors)
        sure, undecided = vector_dedup.decided(held, slice(0, len(unit)), held, 0.93)
        cosine = unit @ unit.T
        assert (cosine[sure] >= 0.93).all() and (cosine[~sure & ~undecided] < 0.93).all()
        assert undecided.mean() < 0.01 or dims < 8


def test_estimates_are_unbiased():
    rng = np.random.default_rng(8)
    a, b = close_pairs(rng, 1, 64, 0.6, 0.6)
    found = [
        vector_dedup.estimates(held, slice(0, 1), held)[0, 1]
        for held in (portion(np.stack([a, b]), seed) for seed in range(300))
    ]
    assert np.std(found) < 0.01 and abs(np.mean(found) - a @ b) < 4 * np.std(found) / np.sqrt(300)


def test_one_large_label_without_clusters_is_stored_once(spark, monkeypatch):
    rng = np.random.default_rng(13)
    vectors = np.concatenate([rng.standard_normal((50_000, 24)), close_pairs(rng, 50, 24)]).astype("float32")
    frame = spark.createDataFrame(
        [(i, v.tolist(), 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int"
    )
    folders = []
    whole = vector_dedup.coded
    monkeypatch.setattr(vector_dedup, "coded", lambda *a: folders.append(whole(*a)) or folders[-1])
    found = {r["vec_id"]: r["n_links"] for r in vector_dedup.near_duplicates(frame).collect()}
    assert spark.read.parquet(folders[0]).count() == len(vectors)
    unit = vector_dedup.scaled(vectors.astype(float))
    degree = np.concatenate([(unit[i : i + 2000] @ unit.T >= 0.93).sum(1) - 1 for i in range(0, len(unit), 2000)])
    assert degree.sum() >= 100 and found == dict(enumerate(degree.tolist()))
