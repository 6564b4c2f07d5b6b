"""The pipeline, stage by stage, against plain Python over the same rows; and the library without this folder."""

import os
import re
import shutil
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

import corpus_pipeline
from flightlake.llm import components, line_crf
from flightlake.llm.packing import Encoder
from flightlake.llm.secrets import RULES
from flightlake.session import materialise
from tests.llm.fixtures import documents, empty
from tests.llm.test_duplicates import least_reachable, plain_fingerprint
from tests.llm.test_mixing import reshared

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def masked(text):
    for rule in RULES:
        text = re.sub(
            rule.pattern,
            lambda m, rule=rule: f"[{rule.kind}]" if len(m[rule.group]) >= rule.min_chars else m[0],
            text,
        )
    return text


def test_the_duplicates_stage_broadcasts_no_cells(spark, monkeypatch):
    plans = []

    def noted(rows, purpose):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return materialise(rows, purpose)

    monkeypatch.setattr(components, "materialise", noted)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert corpus_pipeline.near_duplicates(spark, docs, FOLDER).count() <= docs.count()
    linked = [plan for plan in plans if "Generate posexplode" in plan]
    assert linked and not any("BroadcastHashJoin" in plan for plan in linked)


def test_every_stage_against_plain_python(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = line_crf.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    monkeypatch.setattr(line_crf, "fit", lambda *a, **k: model)
    rows = {r["doc_id"]: r for r in docs.collect()}
    tables = {}
    for name, stage in corpus_pipeline.STAGES:
        tables[name] = docs = materialise(stage(spark, docs, FOLDER), "stage")
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    kept = [i for i, r in rows.items() if line_crf.text_scores([r["text"]], model)[0][0] >= 0.3]
    assert sorted(r["doc_id"] for r in tables["quality classifier"].collect()) == sorted(kept)
    assert len(kept) < len(rows)
    fp = {i: plain_fingerprint(rows[i]["text"]) for i in kept}
    close = [(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4]
    single = {i for i, root in least_reachable(fp, close).items() if i == root}
    assert {r["doc_id"]: r["text"] for r in tables["SimHash near-dedup"].collect()} == {i: rows[i]["text"] for i in single}
    assert len(single) < len(kept)
    clean = {r["doc_id"]: r for r in tables["secret scans"].collect()}
    assert {i: r["text"] for i, r in clean.items()} == {i: masked(rows[i]["text"]) for i in single}
    assert all(r["n_chars"] == len(r["text"]) and r["lang"] == rows[i]["lang"] for i, r in clean.items())
    words, size, taken = Counter(), Counter(), Counter()
    for r in tables["mixing sources"].collect():
        n = len(WORD.findall(r["text"]))
        words[r["doc_id"]] += n
        taken[r["source"]] += n
        assert r["text"].strip() in clean[r["doc_id"]]["text"] and r["n_chars"] == len(r["text"])
    for i, r in clean.items():
        n = len(WORD.findall(r["text"]))
        size[r["source"]] += n
        assert words[i] <= 2 * n
    assert all(abs(taken[s] - t) <= 0.01 * t + 1 for s, t in reshared(dict(size)).items())
    encode, tokens = Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken")), Counter()
    for r in tables["mixing sources"].collect():
        tokens[r["doc_id"]] += len(encode(r["text"])) // 4 + 1
    packed, at = Counter(), defaultdict(list)
    for r in tables["packing"].collect():
        packed[r["doc_id"]] += r["length"]
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    assert packed == tokens
    for parts in at.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
        assert sum(n for _, n in parts) <= 1024


def test_stages_take_awkward_and_empty_tables(spark, tmp_path):
    for name, rows in (("awkward", documents(spark)), ("empty", empty(spark))):
        folder = str(tmp_path / name)
        rows.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame(
            [(0, 1, 0), (4, 0, 0), (7, 1, 1)], "doc_id long, quality int, toxic int"
        ).write.parquet(f"{folder}/labels.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert (found.count() == 0) == (name == "empty")


def test_the_rest_works_without_this_folder(tmp_path):
    repo = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    copy = shutil.copytree(
        repo, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    )
    told = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op1_') for n in e.queries()))"],
        cwd=copy,
        env={**os.environ, "PYTHONPATH": str(copy)},
        capture_output=True,
        text=True,
        check=True,
    )
    assert told.stdout.split()[-1] == "0" and int(told.stdout.split()[-2]) > 100
