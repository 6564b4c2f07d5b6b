"""Sharding and packing: permutation, exact counts, exact tiling, ids against the tokenizer itself."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flightlake.llm import packing, queries
from flightlake.llm.packing import Encoder, pack, plan, sequences, token_pieces
from flightlake.llm.sharding import permute, row_at, shard_rows, write_shards
from tests.llm.fixtures import documents, empty

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokenizer():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.integers(1, 5000), st.integers(0, 5))
@settings(max_examples=40, deadline=None)
def test_permutation_is_a_bijection_with_an_inverse(n, seed):
    shuffled = permute(np.arange(n), n, seed)
    assert sorted(shuffled) == list(range(n))
    assert (permute(shuffled, n, seed, back=True) == np.arange(n)).all()


def test_shards_differ_by_one_row_and_slots_have_no_gap(spark, sf_dir):
    rows = queries.QUERIES["op3_shard_shuffle"](spark, sf_dir).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(x) for x in slots.values()]
    assert max(sizes) - min(sizes) <= 1 and len(slots) == 16
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 for r in rows)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows)
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


def test_places_are_computable_and_follow_no_partitioning(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"))
    one, many = (
        {r["doc_id"]: (r["shard"], r["slot"]) for r in shard_rows(rows.repartition(n), ["doc_id"]).collect()}
        for n in (1, 9)
    )
    assert one == many
    assert all(row_at(*one[i], 1000, 16, 1) == i for i in range(0, 1000, 97))
    sharded = shard_rows(rows, ["doc_id"])
    write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards" / "shard=3")).count() == 63 - (3 >= 1000 % 16)


def test_awkward_rows_get_places(spark):
    rows = documents(spark).withColumn("Shard", F.lit("x")).withColumn("_tie", F.lit(1))
    found = shard_rows(rows, ["doc_id"], n_shards=3).collect()
    assert sorted(Counter(r["shard"] for r in found).values()) == [3, 3, 4]
    assert shard_rows(empty(spark), ["doc_id"]).count() == 0


WHITE = " \n\t\r\x0b\x85　 \x1c"


@given(st.lists(st.text(alphabet="ab'sZ1!é日\U0001f600" + WHITE, max_size=12), max_size=20))
@settings(max_examples=60, deadline=None)
def test_ids_are_the_tokenizers(tokenizer, texts):
    encode = Encoder(RANKS)
    texts = [*texts, "a <|endoftext|>  b", "  x", "x  ", "don't\n\n stop"]
    for text in texts:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == expected


def test_very_long_white_space_is_encoded(tokenizer):
    encode = Encoder(RANKS)
    texts = [x * 2_000_000 for x in (" ", "\n")]
    texts += [f"a{' ' * 1_200_000}b  c{chr(10) * 1_200_000}<|endoftext|>\n d ", f"é\n{' ' * 1_200_000}\n"]
    for text in texts:
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == expected


def test_white_space_runs_apart_give_the_same_ids(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "LONG_RUN", 3)
    encode, rng = Encoder(RANKS), random.Random(1)
    parts = ["a", "b1", "!!", "'s", "日", " ", "\n" * 4, " " * 3, "\t \n", "\x85" * 3, "\u3000" * 4, "<|endoftext|>"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 9)))
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == expected


def test_whole_table_is_packed_exactly(spark, sf_dir, tokenizer):
    rows = queries.QUERIES["op10_pack_sequences"](spark, sf_dir).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(by_doc) == len(docs)
    for doc in docs[::7]:
        ids = np.array([*tokenizer.encode(doc["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for piece in sorted(by_doc[doc["doc_id"]], key=lambda r: r["start"]):
            assert piece["start"] == at and piece["doc_tokens"] == len(ids)
            at += piece["length"]
            assert piece["ids_crc32"] == zlib.crc32(ids[piece["start"] : at].tobytes())
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    used = sum(r["length"] for r in rows)
    assert len(by_sequence) * 1024 <= 1.01 * used + 1024
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_awkward_texts_are_packed(spark, tokenizer):
    pieces = token_pieces(documents(spark).withColumn("length", F.lit("x")), RANKS, window=64)
    packed = pack(pieces.withColumn("offset", F.lit(1)), window=64)
    rows = packed.collect()
    assert sum(r["doc_tokens"] == 1 for r in rows) == 3  # two null texts and an empty one
    assert sum(r["length"] for r in rows) == sum(
        len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
        for r in documents(spark).collect()
    )
    joined = sequences(packed).collect()
    assert all(len(r["ids"]) == 4 * r["tokens"] <= 256 for r in joined)
    assert pack(token_pieces(empty(spark), RANKS)).count() == 0


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=40))
@settings(max_examples=50, deadline=None)
def test_plan_uses_every_count_once_and_fits(counts):
    chosen, used = plan(counts, 64), Counter()
    for lengths, often in chosen:
        assert sum(lengths) <= 64 and often > 0
        for x in lengths:
            used[x] += often
    assert used == Counter(counts)
