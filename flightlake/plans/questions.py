"""A batch of questions answered in one plan: checked, searched, gated, assembled."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.constants import MAX_TOP_K, METADATA_FIELDS
from flightlake.functions.text import redact
from flightlake.operators.batch_facts import agent_batch_facts, batch_facts
from flightlake.operators.documents import metadata_defaults
from flightlake.operators.requests import (
    assemble_context,
    citations,
    facts_query_type,
    fallback_answer,
    retrieval_gate,
    route_question,
    tools_used,
    validate_requests,
    with_session,
)
from flightlake.operators.sessions import last_turns, session_history
from flightlake.operators.vectors import embed_documents, vector_top_k
from flightlake.session import materialise
from flightlake.sources.document_table import BROADCAST_IDS, bloom_filter, may_hold


def accepted(requests: DataFrame) -> DataFrame:
    """Valid requests with the path they are routed to and the facts report they would need."""
    valid = validate_requests(requests).where(F.col("error").isNull())
    return facts_query_type(route_question(valid))


def matched_documents(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Each question's nearest documents, as many as it asks for, with their metadata."""
    questions = embed_documents(requests.select("request_id", "question"), "question")
    matches = vector_top_k(questions, documents, MAX_TOP_K)
    wanted = (
        matches.join(requests.select("request_id", "top_k"), "request_id")
        .where(F.col("match_rank") <= F.col("top_k"))
        .drop("top_k")
    )
    return metadata_defaults(
        with_documents(materialise(wanted, "hits"), documents, METADATA_FIELDS), METADATA_FIELDS
    )


def with_documents(
    hits: DataFrame, documents: DataFrame, fields: list[str], few: int = BROADCAST_IDS
) -> DataFrame:
    """Hits with the named fields of their documents; a hit whose document is gone is left out.

    ``hits`` is a stored table. Its different ids, an id each however many questions
    found it, are broadcast up to ``few``, so documents stay where they lie and only
    found ones move. Beyond, a Bloom filter of the ids lets go of documents that no
    question found before the others are shuffled.
    """
    found = materialise(hits.select("doc_id").distinct(), "found")
    count = found.count()
    rows = documents.select("doc_id", *fields)
    if count <= few:
        kept = rows.join(F.broadcast(found), "doc_id", "left_semi")
    else:
        words = materialise(bloom_filter(found, count), "bloom")
        kept = rows.where(may_hold(words.scalar(), "doc_id")).join(found, "doc_id", "left_semi")
    return hits.join(kept, "doc_id")


def search_requests(requests: DataFrame, documents: DataFrame) -> DataFrame:
    """Search results with cleaned content and similarity to four places."""
    return matched_documents(requests, documents).select(
        "request_id",
        "match_rank",
        "doc_id",
        F.round("distance", 4).alias("similarity"),
        redact(F.col("content")).alias("content"),
        "airline",
        "route",
        "event_date",
    )


def answer_contexts(
    requests: DataFrame,
    entries: DataFrame,
    documents: DataFrame,
    silver: DataFrame,
    routes: DataFrame,
    as_of: dt.date,
    matches: DataFrame | None = None,
) -> DataFrame:
    """Everything a retrieval answer is written from, one row per valid request.

    That is the three context blocks, the citations, the counts, the path the
    question would be routed to, and the fixed-form answer that stands in when no model
    writes one. Facts are fetched for questions with few matches, documents first.

    ``documents`` carries an ``embedding`` of the same kind as the questions;
    ``matches`` may be given where another search has already found them. The
    search, the checked questions and the facts are stored once each, as several
    branches need them.
    """
    gated, matches = _searched(requests, documents, matches)
    facts = batch_facts(gated.where("needs_facts"), documents, silver, routes, as_of)
    return _contexts(gated, entries, matches, facts)


def ask_batch(
    requests: DataFrame,
    entries: DataFrame,
    documents: DataFrame,
    silver: DataFrame,
    routes: DataFrame,
    as_of: dt.date,
    matches: DataFrame | None = None,
) -> DataFrame:
    """The router over a batch: each question takes the path that ``routed_to`` names.

    ``retrieve`` questions are answered as in ``answer_contexts``: facts only after
    few matches, documents first. ``agent`` questions compare, rank or span several
    parts, so their facts are always fetched, the named report first and the
    documents where it has no row. Both share one search and one set of sessions.
    """
    gated, matches = _searched(requests, documents, matches)
    by_agent = F.col("routed_to") == "agent"
    facts = batch_facts(
        gated.where(~by_agent & F.col("needs_facts")), documents, silver, routes, as_of
    ).unionByName(agent_batch_facts(gated.where(by_agent), documents, silver, routes, as_of))
    return _contexts(gated, entries, matches, facts)


def _searched(
    requests: DataFrame, documents: DataFrame, matches: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """The valid requests with their hit counts, and their matches, both stored."""
    asked = materialise(accepted(requests), "asked")
    if matches is None:
        matches = matched_documents(asked, documents)
    matches = materialise(matches, "matches")
    return materialise(retrieval_gate(asked, matches), "gated"), matches


def _contexts(
    gated: DataFrame, entries: DataFrame, matches: DataFrame, facts: DataFrame
) -> DataFrame:
    facts = materialise(facts, "answers")
    history = session_history(entries)
    facts_found = facts.groupBy("request_id").agg(F.count("*").alias("facts_count"))
    asking = gated.select(
        "request_id", "session_id", "routed_to", F.col("vs_results").alias("context_count")
    )
    extras = (
        with_session(asking, history.select("session_id", "history_turns"))
        .join(facts_found, "request_id", "left")
        .join(citations(matches), "request_id", "left")
        .withColumns(
            {
                "facts_count": F.coalesce("facts_count", F.lit(0).cast("bigint")),
                "history_turns": F.coalesce("history_turns", F.lit(0)),
            }
        )
    )
    contexts = assemble_context(gated, last_turns(entries), matches, facts)
    return tools_used(fallback_answer(contexts, facts).join(extras, "request_id"))
