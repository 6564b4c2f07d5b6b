import numpy as np
import pytest
from pyspark.sql import functions as F

from flightlake.operators import documents as docs
from flightlake.operators import vectors
from flightlake.schemas import BRONZE, RAG_DOCUMENTS
from flightlake.sources import document_table as levels
from flightlake.sources import documents as files


def version(doc_id, content, when):
    return (doc_id, content, "flight_event", "AA", "ATL-LAX", None, [1.0], "{}", when)


def table(spark, *rows):
    import datetime as dt

    stamped = [(*r[:-1], dt.datetime(2024, 1, r[-1])) for r in rows]
    return spark.createDataFrame(stamped, RAG_DOCUMENTS)


def contents(df):
    return sorted((r["doc_id"], r["content"]) for r in df.collect())


def test_document_sentence(spark):
    raw = [("F1", "AA", "ATL", "LAX", "5", "-3", "TRUE", "ON_TIME", "2024-01-05T23:30:00+00:00")]
    row = docs.rag_documents(spark.createDataFrame(raw, BRONZE)).collect()[0]
    assert row["content"] == (
        "Flight F1 for airline AA on route ATL-LAX had departure delay 5 minutes and arrival "
        "delay -3 minutes. Status was ON_TIME. Weather impact flag was True. "
        "Event timestamp was 2024-01-05T23:30:00+00:00."
    )
    assert row["metadata"] == (
        '{"status":"ON_TIME","weather_flag":true,"departure_delay_min":5,"arrival_delay_min":-3}'
    )
    assert (row["doc_id"], str(row["event_date"])) == ("F1", "2024-01-05")


def test_upsert_updates_inserts_and_repeats(spark):
    target = table(spark, version("a", "old", 1), version("b", "old", 1))
    batch = table(spark, version("b", "new", 2), version("b", "newest", 3), version("c", "x", 2))
    once = docs.upsert_rag_documents(target, batch)
    assert contents(once) == [("a", "old"), ("b", "newest"), ("c", "x")]
    assert contents(docs.upsert_rag_documents(once, batch)) == contents(once)
    assert contents(docs.upsert_rag_documents(target, batch.limit(0))) == contents(target)


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "docs")
    files.write_rag_table(table(spark, version("a", "old", 1)), path)
    batch = table(spark, version("a", "new", 2))
    merged = docs.upsert_rag_documents(files.read_rag_table(spark, path), batch)
    merged.collect()
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def data_files(folder):
    return {f: f.stat().st_mtime_ns for f in folder.rglob("part-*.parquet")}


def test_table_upsert_rewrites_no_file(spark, tmp_path):
    levels.create_document_table(spark, "doc_table", str(tmp_path / "docs"))
    assert levels.read_document_table(spark, "doc_table").count() == 0
    rows = spark.range(20_000).selectExpr(
        "concat('d', id) AS doc_id", "'old' AS content", "TIMESTAMP '2024-01-01' AS updated_ts"
    )
    whole = table(spark).unionByName(rows, allowMissingColumns=True)
    levels.upsert_table(spark, "doc_table", whole)
    before = data_files(tmp_path / "docs")
    batch = whole.where("pmod(xxhash64(doc_id), 4) = 0").withColumn("content", F.lit("new"))
    assert batch.count() > 4_000
    for _ in range(2):
        levels.upsert_table(spark, "doc_table", batch)
        found = levels.read_document_table(spark, "doc_table").groupBy("content").count().collect()
        assert {r["content"]: r["count"] for r in found} == {
            "new": batch.count(),
            "old": 20_000 - batch.count(),
        }
    after = data_files(tmp_path / "docs")
    assert before.items() <= after.items()
    levels.upsert_table(spark, "doc_table", batch.limit(0))
    assert levels.read_document_table(spark, "doc_table").count() == 20_000


def test_newest_of_a_batch_replaces_what_the_table_has(spark, tmp_path):
    levels.create_document_table(spark, "doc_order", str(tmp_path / "docs"))
    levels.upsert_table(spark, "doc_order", table(spark, version("a", "late", 9), version("b", "old", 1)))
    batch = table(spark, version("a", "early", 2), version("a", "earlier", 1), version("c", "x", 2))
    levels.upsert_table(spark, "doc_order", batch)
    expected = [("a", "early"), ("b", "old"), ("c", "x")]
    assert contents(levels.read_document_table(spark, "doc_order")) == expected
    old = data_files(tmp_path / "docs")
    levels.compact_table(spark, "doc_order", least=3)
    assert data_files(tmp_path / "docs") == old
    levels.compact_table(spark, "doc_order", least=2, kept_seconds=0)
    assert contents(levels.read_document_table(spark, "doc_order")) == expected
    assert not data_files(tmp_path / "docs").keys() & old.keys()
    levels.upsert_table(spark, "doc_order", table(spark, version("b", "new", 1)))
    assert dict(contents(levels.read_document_table(spark, "doc_order")))["b"] == "new"


@pytest.mark.parametrize("call", ["upsert", "compact"])
def test_interrupted_change_has_no_effect_and_can_be_repeated(spark, tmp_path, monkeypatch, call):
    name = f"doc_broken_{call}"
    levels.create_document_table(spark, name, str(tmp_path / "docs"))
    levels.upsert_table(spark, name, table(spark, version("a", "old", 1), version("b", "old", 1)))
    levels.upsert_table(spark, name, table(spark, version("b", "newer", 1)))
    before = contents(levels.read_document_table(spark, name))
    batch = table(spark, *[version(i, "new", 2) for i in "abcdefgh"])
    statement = type(spark).sql

    def change():
        if call == "upsert":
            levels.upsert_table(spark, name, batch)
        else:
            levels.compact_table(spark, name, least=1)

    def failing(self, text, *args, **kwargs):
        if text.startswith("ALTER") and ("DROP" in text) == (call == "compact"):
            raise RuntimeError("driver lost")
        return statement(self, text, *args, **kwargs)

    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "sql", failing)
        with pytest.raises(RuntimeError):
            change()
    assert contents(levels.read_document_table(spark, name)) == before
    change()
    expected = [(i, "new") for i in "abcdefgh"] if call == "upsert" else before
    assert contents(levels.read_document_table(spark, name)) == expected


def ancestors(plan):
    """Each line of a physical plan with the lines above it that it feeds."""
    open_lines = []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        open_lines = [(d, t) for d, t in open_lines if d < depth]
        yield line, [t for _, t in open_lines]
        open_lines.append((depth, line))


@pytest.fixture
def layered(spark, tmp_path):
    """A base of 3,000 documents and two merges over parts of it; (table, expected contents)."""
    name = f"doc_levels_{tmp_path.name}".replace("-", "_")
    levels.create_document_table(spark, name, str(tmp_path / "docs"))
    base = spark.range(3000).selectExpr(
        "concat('d', id) AS doc_id", "'old' AS content", "TIMESTAMP '2024-01-01' AS updated_ts"
    )
    base = table(spark).unionByName(base, allowMissingColumns=True)
    expected = {f"d{i}": "old" for i in range(3000)}
    levels.upsert_table(spark, name, base)
    for step, ids in (("one", range(0, 900)), ("two", range(600, 1200))):
        named = [f"d{i}" for i in ids]
        levels.upsert_table(spark, name, base.where(F.col("doc_id").isin(named)).withColumn("content", F.lit(step)))
        expected |= dict.fromkeys(named, step)
    return name, sorted(expected.items())


def test_reader_moves_ids_only(spark, layered):
    name, expected = layered
    read = levels.read_document_table(spark, name)
    assert contents(read) == expected
    plan = read._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    moved = [above for line, above in ancestors(plan) if "Exchange hashpartitioning" in line]
    assert moved and all(any("BroadcastExchange" in a for a in above) for above in moved)


def test_many_newer_ids_shuffle_only_rows_that_may_have_one(spark, layered, monkeypatch):
    name, expected = layered
    monkeypatch.setattr(levels, "BROADCAST_IDS", 10)
    read = levels.read_document_table(spark, name)
    assert contents(read) == expected
    assert "LeftAnti" in read._jdf.queryExecution().executedPlan().toString()
    newest = levels.published(spark, name)[0]
    words = spark.read.parquet(f"{levels.root_folder(spark, name)}/{newest.folder}/bloom").scalar()
    held = read.select("content", levels.may_hold(words, "doc_id").alias("may"))
    counts = {(r["content"] == "two", r["may"]): r["n"] for r in held.groupBy("content", "may").agg(F.count("*").alias("n")).collect()}
    assert (True, False) not in counts
    assert held.where("content <> 'two' AND may").count() < 0.05 * 2400


def test_compaction_rewrites_a_level_only(spark, layered, tmp_path):
    name, expected = layered
    levels.compact_table(spark, name, least=3, kept_seconds=0)
    (base,) = levels.published(spark, name)
    assert (base.level, base.low, base.version, base.ids) == (1, 1, 3, 3000)
    kept = data_files(tmp_path / "docs" / base.folder)
    for i in range(3):
        levels.upsert_table(spark, name, table(spark, version(f"n{i}", "new", 2), version("d0", f"v{i}", 2)))
        levels.compact_table(spark, name, least=3, kept_seconds=0)
    young, old = levels.published(spark, name)
    assert old == base and kept.items() <= data_files(tmp_path / "docs").items()
    assert (young.level, young.low, young.version, young.ids) == (1, 4, 6, 4)
    changed = dict(expected) | {"d0": "v2", "n0": "new", "n1": "new", "n2": "new"}
    assert contents(levels.read_document_table(spark, name)) == sorted(changed.items())
    assert {f.name for f in (tmp_path / "docs").iterdir()} - {"empty"} == {young.folder, old.folder}


def test_folders_of_broken_merges_are_dropped_when_old(spark, layered, tmp_path, monkeypatch):
    name, expected = layered
    folders = {f.name for f in (tmp_path / "docs").iterdir()}
    with monkeypatch.context() as patch:
        patch.setattr(levels, "bloom_filter", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            levels.upsert_table(spark, name, table(spark, version("a", "lost", 2)))
    assert len({f.name for f in (tmp_path / "docs").iterdir()} - folders) == 1
    levels.drop_orphans(spark, name)
    assert len({f.name for f in (tmp_path / "docs").iterdir()} - folders) == 1
    levels.drop_orphans(spark, name, kept_seconds=0)
    assert {f.name for f in (tmp_path / "docs").iterdir()} == folders
    assert contents(levels.read_document_table(spark, name)) == expected


def test_writers_that_meet_take_their_version_back(spark, layered, monkeypatch):
    name, expected = layered
    seen = levels.published(spark, name)
    levels.upsert_table(spark, name, table(spark, version("d1", "first", 2)))
    real, calls = levels.published, []

    def late(spark_, table_):
        calls.append(1)
        return seen if len(calls) == 1 else real(spark_, table_)

    monkeypatch.setattr(levels, "published", late)
    with pytest.raises(RuntimeError, match="merge again"):
        levels.upsert_table(spark, name, table(spark, version("d1", "second", 2)))
    assert dict(contents(levels.read_document_table(spark, name)))["d1"] == "first"


def test_merge_statement_needs_a_row_level_format(spark):
    table(spark, version("a", "old", 1)).write.mode("overwrite").saveAsTable("plain_docs")
    with pytest.raises(Exception, match="MERGE"):
        files.merge_into(table(spark, version("a", "new", 2)), "plain_docs")


def test_staged_rows_require_their_fields(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("a", None)], "doc_id string, content string").write.json(path)
    with pytest.raises(Exception, match="required field is missing: content"):
        files.staged_rows(spark, path).collect()


def test_model_is_called_in_small_batches_and_retried(spark):
    def model(texts):
        import random

        assert len(texts) <= 5
        if random.random() < 0.5:
            raise RuntimeError("busy")
        return [[float(len(t))] for t in texts]

    rows = spark.range(23).select("id", F.repeat(F.lit("x"), F.col("id").cast("int")).alias("content"))
    embedded = vectors.embed_with_model(rows, model, attempts=40, first_wait=0.0)
    assert all(r["embedding"] == [float(r["id"])] for r in embedded.collect())


def test_model_failure_is_not_hidden(spark):
    def model(texts):
        raise RuntimeError("model is down")

    rows = spark.createDataFrame([("a",)], "content string")
    with pytest.raises(Exception, match="model is down"):
        vectors.embed_with_model(rows, model, attempts=2, first_wait=0.0).collect()


# --- search ---


def points(spark, matrix, name):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<double>")


def brute_force(questions, matrix, k):
    scores = np.round(questions @ matrix.T, 6)
    best = []
    for q, row in enumerate(scores):
        order = sorted(range(len(row)), key=lambda d: (-row[d], d))[:k]
        best += [(q, d, rank + 1) for rank, d in enumerate(order)]
    return sorted(best)


def found(df):
    return sorted((r["request_id"], r["doc_id"], r["match_rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def crowded():
    """Points of which a third are copies of one, so that ties and a hot cell occur."""
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(600, 8))
    matrix[::3] = matrix[0]
    return matrix, rng.normal(size=(40, 8))


@pytest.mark.parametrize("k", [1, 5, 20])
def test_exact_search_in_one_block_and_in_several(spark, crowded, k):
    matrix, asked = crowded
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, asked, "request_id")
    expected = brute_force(asked, matrix, k)
    assert found(vectors.vector_top_k(questions, docs_.repartition(5), k)) == expected
    assert found(vectors.vector_top_k(questions, docs_, k, block=12)) == expected
    assert vectors.vector_top_k(questions.limit(0), docs_, k).count() == 0


def test_exact_search_scans_documents_once_and_collects_nothing(spark, crowded, tmp_path, monkeypatch):
    matrix, asked = crowded
    points(spark, matrix, "doc_id").write.parquet(str(tmp_path / "docs"))
    docs_, questions = spark.read.parquet(str(tmp_path / "docs")), points(spark, asked, "request_id")
    monkeypatch.setattr(vectors, "HELD_MATCHES", 30)
    monkeypatch.setattr(type(docs_), "collect", None)
    monkeypatch.setattr(type(docs_), "toArrow", None)
    best = vectors.vector_top_k(questions, docs_, 5, block=7)
    monkeypatch.undo()
    assert best._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert found(best) == brute_force(asked, matrix, 5)


def saved_and_loaded(spark, docs_, path, **options):
    vectors.VectorLeaves.build(docs_, **options).save(path)
    return vectors.VectorLeaves.load(spark, path)


def test_leaves_are_exact_when_all_are_visited(spark, crowded, tmp_path):
    matrix, asked = crowded
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, asked, "request_id")
    leaves = saved_and_loaded(spark, docs_, str(tmp_path / "leaves"), leaf_size=60)
    assert leaves.leaves.select("doc_id").distinct().count() == len(matrix)
    full = leaves.search(questions, 5, searched=1.0, doc_block=50, question_block=16)
    assert found(full) == brute_force(asked, matrix, 5)


def test_leaves_keep_their_size_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(vectors, "MOST_CHILDREN", 6)
    monkeypatch.setattr(vectors, "DOC_BLOCK", 200)
    matrix = np.random.default_rng(4).normal(size=(1500, 6))
    leaves = vectors.VectorLeaves.build(points(spark, matrix, "doc_id"), leaf_size=20)
    sizes = [r["count"] for r in leaves.leaves.groupBy("leaf").count().collect()]
    assert leaves.leaves.select("doc_id").distinct().count() == 1500
    assert leaves.leaves.select("cell").distinct().count() <= 6 < len(sizes)
    assert len(sizes) <= leaves.centres.count() <= 2 * 1500 / 20
    assert np.mean(sizes) <= 2 * 20 and max(sizes) <= 6 * 20
    twice = leaves.leaves.groupBy("doc_id").count().where("count = 2").count()
    assert 0 < twice < 1500


def test_measured_share_reaches_the_wanted_recall(spark):
    rng = np.random.default_rng(9)
    matrix = rng.normal(size=(800, 16))
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, rng.normal(size=(60, 16)), "request_id")
    leaves = vectors.VectorLeaves.build(docs_, leaf_size=20)
    exact = vectors.vector_top_k(questions, docs_, 5)
    assert 0.07 < leaves.searched < 1
    assert vectors.recall(leaves.search(questions, 5), exact).collect()[0]["recall"] >= 0.85
    hits = {(r["request_id"], r["doc_id"]): r for r in leaves.search(questions, 5).collect()}
    asked = np.array([r["embedding"] for r in questions.orderBy("request_id").collect()])
    for (q, d), r in hits.items():
        assert abs(r["distance"] - asked[q] @ matrix[d]) < 1e-5


def test_pruned_search_reads_visited_cells_only(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = np.eye(10) * 10
    matrix = np.repeat(centres, 60, axis=0) + rng.normal(size=(600, 10)) * 0.1
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, centres, "request_id")
    leaves = saved_and_loaded(spark, docs_, str(tmp_path / "c"), leaf_size=30, iterations=20)
    exact = vectors.vector_top_k(questions, docs_, 5)
    assert vectors.recall(leaves.search(questions, 5), exact).collect()[0]["recall"] >= 0.9
    one = leaves.search(questions.where("request_id = 0"), 5, searched=0.1)
    assert "PartitionFilters" in one._jdf.queryExecution().toString()


def test_leaf_search_copies_no_vector(spark, crowded, tmp_path):
    """Vectors are neither joined to leaves nor shuffled; a question's leaves are one value beside it."""
    matrix, asked = crowded
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, asked, "request_id")
    leaves = saved_and_loaded(spark, docs_, str(tmp_path / "leaves"), leaf_size=20)
    for searched in (0.3, 1.0):
        plan = leaves.search(questions, 5, searched)._jdf.queryExecution().executedPlan().toString()
        moved = [above for line, above in ancestors(plan) if "Exchange" in line]
        assert moved and "CoGroup" not in plan and "Join" not in plan
        assert all("embedding" not in line for line in plan.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("held", [300, 1 << 20])
def test_sparse_vectors_in_portions(spark, monkeypatch, held):
    """Long lists of vectors with mostly zeros, equal ones, empty ones and questions that hit nothing."""
    monkeypatch.setattr(vectors, "HELD_VALUES", held)
    monkeypatch.setattr(vectors, "DOC_BLOCK", 2000)
    rng = np.random.default_rng(5)
    matrix, asked = np.zeros((9000 if held > 300 else 500, 60)), np.zeros((30, 60))
    for rows, words in ((matrix, 4), (asked, 6)):
        np.add.at(rows, (np.repeat(np.arange(len(rows)), words), rng.integers(0, 59, len(rows) * words)), 1.0)
    matrix[:, 0] += 2
    matrix[::7] = matrix[3]
    matrix[5::50], asked[0], asked[1] = 0.0, 0.0, np.eye(60)[59]
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, asked, "request_id")
    assert found(vectors.vector_top_k(questions, docs_.coalesce(1), 5, block=8)) == brute_force(asked, matrix, 5)


def test_an_id_that_comes_twice_is_found_once_in_leaves(spark):
    rng = np.random.default_rng(6)
    matrix, asked = rng.normal(size=(700, 6)), rng.normal(size=(9, 6))
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, asked, "request_id")
    leaves = vectors.VectorLeaves.build(docs_.unionByName(docs_), leaf_size=40)
    assert found(leaves.search(questions, 20, searched=1.0)) == brute_force(asked, matrix, 20)


def test_later_portions_hand_on_only_what_can_be_among_the_best(spark, monkeypatch):
    """Ten portions in one task, the best documents in the first; equal ones of later portions still count."""
    monkeypatch.setattr(vectors, "HELD_VALUES", 400)
    rng = np.random.default_rng(2)
    asked = np.abs(rng.normal(size=(12, 4)))
    matrix = np.sort(np.abs(rng.normal(size=(1000, 1))), axis=0)[::-1] * np.ones((1, 4))
    matrix[500:503] = matrix[0]
    docs_ = points(spark, matrix, "doc_id").coalesce(1).sortWithinPartitions(F.desc(F.col("doc_id") % 1000 == 500), "doc_id")
    questions = points(spark, asked, "request_id")
    schema = vectors._match_schema(questions, docs_)
    handed = vectors.score_where_they_lie(vectors.stored_blocks(questions), docs_, 5, schema, 7)
    assert handed.count() <= 12 * (5 + 5)
    assert found(vectors.vector_top_k(questions, docs_, 5, block=7)) == brute_force(asked, matrix, 5)


def test_memory_of_a_search_is_bounded(spark):
    """Stored questions are read in small row groups, and a portion is held once, not beside its batches."""
    import tracemalloc
    from pathlib import Path

    import pyarrow as pa
    import pyarrow.parquet as pq

    rng = np.random.default_rng(8)
    asked = spark.range(20000).select(
        F.col("id").alias("request_id"), F.transform(F.sequence(F.lit(1), F.lit(64)), lambda x: F.rand(3) * x).alias("embedding")
    )
    for file in Path(vectors.stored_blocks(asked.coalesce(1))).glob("*.parquet"):
        told = pq.read_metadata(file)
        sizes = [told.row_group(i).total_byte_size for i in range(told.num_row_groups)]
        assert len(sizes) > 1 and max(sizes) <= 2 * vectors.QUESTION_BYTES

    def batches():
        for start in range(0, 40000, 1000):
            values = pa.array(rng.normal(size=64000))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(1001) * 64, pa.int32()), values)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(start, start + 1000)), lists], ["doc_id", "embedding"])

    tracemalloc.start()
    held = []
    for portion in vectors._gatherer(640_000, 8192, False, None)(batches()):
        held.append(tracemalloc.get_traced_memory()[0])
        portion = None
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(held) == 4 and max(held) < 1.6 * 640_000 * 8 and peak < 2.6 * 640_000 * 8


def test_vectors_of_mostly_zeros_are_sent_and_held_thin(spark):
    """A whole vector of 768 numbers has 6,144 bytes; a portion's peak in Python is a few times what it holds."""
    import tracemalloc

    import pyarrow as pa

    texts = spark.range(400).selectExpr("id doc_id", "concat('flight ', id, ' on route ', id % 20, ' was late') content")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes], "rows": [batch.num_rows]})

    sent = vectors.thin_rows(vectors.embed_documents(texts), "doc_id").coalesce(1)
    told = sent.mapInArrow(sizes, "bytes long, rows long").groupBy().sum().first()
    assert told[0] < 300 * told[1] and told[1] == 400

    def batches(width=768, filled=10):
        rng = np.random.default_rng(3)
        for start in range(0, 40_000, 1000):
            bits = np.zeros((1000, width), bool)
            bits[np.arange(1000)[:, None], rng.integers(0, width, (1000, filled))] = True
            ends = pa.array(np.append(0, bits.sum(1).cumsum()), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(start, start + 1000)),
                    pa.ListArray.from_arrays(ends, pa.array(rng.normal(size=bits.sum()))),
                    pa.ListArray.from_arrays(pa.array(np.arange(1001) * width, pa.int32()), pa.array(bits.ravel())),
                ],
                ["doc_id", "values", "filled"],
            )

    held = 800_000
    tracemalloc.start()
    portions = [len(portion["ids"]) for portion in vectors._gatherer(held, 2048, False, None)(batches())]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(portions) == 40_000 and max(portions) * 11 * vectors.THIN_WEIGHT <= 1.1 * held
    assert peak < 4 * held * 8


@pytest.mark.parametrize("zeros", [0.0, 0.9])
def test_rows_without_a_vector_and_negative_zeros(spark, zeros):
    rng = np.random.default_rng(9)
    asked, matrix = rng.normal(size=(9, 20)), rng.normal(size=(300, 20))
    matrix[rng.random(matrix.shape) < zeros] = -0.0
    matrix[:, 3] = np.where(np.arange(300) % 2, -0.0, 0.0)
    docs_, questions = points(spark, matrix, "doc_id"), points(spark, asked, "request_id")
    none = docs_.limit(40).withColumns(
        {"doc_id": F.col("doc_id") + 5000, "embedding": F.when(F.col("doc_id") % 2 == 0, F.slice("embedding", 1, 0))}
    )
    for rows in (docs_.unionByName(none).coalesce(1), none.unionByName(docs_).repartition(3)):
        assert found(vectors.vector_top_k(questions, rows, 5)) == brute_force(asked, matrix, 5)
    assert vectors.vector_top_k(questions, none, 5).count() == 0


def test_k_is_bounded(spark, crowded):
    matrix, asked = crowded
    with pytest.raises(ValueError):
        vectors.vector_top_k(
            points(spark, asked, "request_id"), points(spark, matrix, "doc_id"), 21
        )


def test_same_text_has_the_same_vector(spark):
    rows = spark.createDataFrame([("Delay at ATL!",), ("delay   at atl",), ("",)], "content string")
    first, second, empty = [r["embedding"] for r in vectors.embed_documents(rows).collect()]
    assert first == second and len(first) == 768
    assert sum(empty) == 0.0
