"""Every registered query against its SQL, on whole tables."""

from collections import Counter

import numpy as np
import pytest
import regex

import __spark_entry__ as contract
from checks import fixtures as fx
from checks.registry import ORACLES, QUERIES
from flightlake.operators.requests import validate_requests
from flightlake.operators.vectors import recall

ROWS_ONLY = {
    "vector_top_k_cells",
    "vector_recall",
    "search_flight_records",
    "question_references",
    "tool_search",
}


def comparable(rows):
    def value(x):
        return round(x, 9) if isinstance(x, float) else x

    return sorted((tuple(value(x) for x in row) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(name, spark, sf_dir, sql_engine):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    found = comparable(result.select(*columns).collect())
    answer = sql_engine.execute(ORACLES[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    places = [names.index(column) for column in columns]
    expected = comparable([[row[i] for i in places] for row in answer.fetchall()])
    assert expected, "the comparison must not be empty"
    assert found == expected


def test_rows_only_queries_are_the_known_ones():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY


def test_entry_has_ten_routes(spark):
    assert contract.entry(spark).count() == 10


def test_pruned_search_finds_most_matches(spark, sf_dir):
    row = QUERIES["vector_recall"](spark, sf_dir).collect()[0]
    found = QUERIES["vector_top_k_cells"](spark, sf_dir)
    exact = QUERIES["vector_top_k"](spark, sf_dir)
    assert found.groupBy("request_id").count().where("count > 5").isEmpty()
    assert row["exact_matches"] == exact.count()
    assert recall(exact, exact).collect()[0]["recall"] == 1.0
    assert row["recall"] >= 0.9 and row["recall_at_least_share"] <= row["recall"]
    hits = found.join(exact.drop("match_rank"), ["request_id", "doc_id", "distance"])
    assert hits.count() == row["found_matches"]


def test_search_stays_within_each_questions_k(spark, sf_dir):
    found = QUERIES["search_flight_records"](spark, sf_dir)
    assert found.where("match_rank > 20 OR similarity > 1.0001").isEmpty()
    assert not found.isEmpty()


def murmur3(data, seed=42):
    """The 32-bit hash with which words find their place, signed."""
    low = 0xFFFFFFFF

    def turn(x, r):
        return (x << r | x >> (32 - r)) & low

    def mixed(k):
        return turn(k * 0xCC9E2D51 & low, 15) * 0x1B873593 & low

    h, whole = seed, len(data) // 4 * 4
    for at in range(0, whole, 4):
        h = (turn(h ^ mixed(int.from_bytes(data[at : at + 4], "little")), 13) * 5 + 0xE6546B64) & low
    if len(data) > whole:
        h ^= mixed(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & low
    h = (h ^ h >> 13) * 0xC2B2AE35 & low
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def plain_embedding(text, place=None):
    vector, place = np.zeros(768), {} if place is None else place
    for word, times in Counter(w for w in regex.split(r"[^\p{L}\p{N}]+", text.lower()) if w).items():
        if word not in place:
            place[word] = murmur3(word.encode()) % 768
        vector[place[word]] += times
    length = np.sqrt((vector**2).sum())
    return vector / length if length else vector


def test_every_question_finds_what_plain_python_finds(spark, sf_dir):
    """All questions against all documents: places of words, products, ranks and ties."""
    place, columns = {}, ["request_id", "question", "top_k"]
    asked = QUERIES["facts_query_type"](spark, sf_dir).select("request_id")
    asked = fx.requests(spark, sf_dir).join(asked, "request_id")
    questions = validate_requests(asked).select(*columns).collect()
    documents = sorted(map(tuple, fx.document_table(spark, sf_dir).select("doc_id", "content").collect()))
    ids = np.array([doc_id for doc_id, _ in documents])
    filed = np.stack([plain_embedding(text, place) for _, text in documents])
    expected = {}
    for number, question, top_k in questions:
        products = np.round(filed @ plain_embedding(question, place), 6)
        best = np.argsort(-products, kind="stable")[:top_k]
        expected[number] = [(n + 1, ids[i], round(products[i], 4)) for n, i in enumerate(best)]
    found = {}
    rows = QUERIES["search_flight_records"](spark, sf_dir).select("request_id", "match_rank", "doc_id", "similarity")
    for row in sorted(map(tuple, rows.collect())):
        found.setdefault(row[0], []).append(row[1:])
    assert found.keys() == {number for number, hits in expected.items() if hits}
    for number, hits in found.items():
        assert [hit[:2] for hit in hits] == [hit[:2] for hit in expected[number]]
        assert np.allclose([hit[2] for hit in hits], [hit[2] for hit in expected[number]], atol=1.01e-4)
    cited = QUERIES["question_references"](spark, sf_dir).select("request_id", "sources").collect()
    assert {n: s.split(",") for n, s in cited if s} == {n: [hit[1] for hit in hits] for n, hits in found.items()}
    answer = QUERIES["tool_search"](spark, sf_dir).orderBy("match_rank").collect()
    products = np.round(filed @ plain_embedding("weather delays on route ATL-LAX", place), 6)
    assert [row["doc_id"] for row in answer] == list(ids[np.argsort(-products, kind="stable")[:5]])


def test_references_belong_to_valid_requests(spark, sf_dir):
    references = QUERIES["question_references"](spark, sf_dir)
    asked = QUERIES["facts_query_type"](spark, sf_dir)
    assert references.count() == asked.count()
    assert references.where("docs_block NOT LIKE '[Ref 1] flight_event — %'").isEmpty()
