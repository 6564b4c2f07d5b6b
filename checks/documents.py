"""Retrieval documents, upsert, vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import redact, sql
from flightlake.constants import LEAVES_SEARCHED
from flightlake.operators import documents as docs
from flightlake.operators import vectors
from flightlake.operators.requests import redact_instructions
from flightlake.session import materialise, work_folder

DOC_COLUMNS = "doc_id, content, source_type, airline, route, event_date, metadata"


@query("rag_documents", sql(f"SELECT {DOC_COLUMNS} FROM doc_rows"))
def rag_documents(spark, sf):
    return docs.rag_documents(fx.flights_text(spark, sf))


@query("latest_per_doc", sql("SELECT * FROM docs"))
def latest_per_doc(spark, sf):
    return fx.document_table(spark, sf)


@query(
    "except_column",
    sql("SELECT * EXCLUDE (metadata) FROM docs"),
)
def except_column(spark, sf):
    return docs.except_column(fx.document_table(spark, sf), "metadata")


@query("upsert_rag_documents", sql("SELECT * FROM merged"))
def upsert_rag_documents(spark, sf):
    return docs.upsert_rag_documents(
        fx.document_table(spark, sf), fx.document_batch(spark, sf)
    )


@query("upsert_repeated", sql("SELECT * FROM merged"))
def upsert_repeated(spark, sf):
    """The same batch once more changes nothing."""
    batch = fx.document_batch(spark, sf)
    once = docs.upsert_rag_documents(fx.document_table(spark, sf), batch)
    return docs.upsert_rag_documents(once, batch)


@query(
    "zip_docs_vectors",
    "SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, d.lang, len(e.embedding) AS dimensions "
    "FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id",
)
def zip_docs_vectors(spark, sf):
    documents = fx.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "lang"
    )
    vector_rows = fx.table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"), "embedding"
    )
    return docs.zip_docs_vectors(documents, vector_rows).select(
        "doc_id", "lang", F.size("embedding").cast("bigint").alias("dimensions")
    )


@query(
    "metadata_defaults",
    "SELECT l.doc_id, coalesce(d.lang, '') AS lang, coalesce(d.source, '') AS source, "
    "coalesce(CAST(l2.quality AS VARCHAR), '') AS quality "
    "FROM documents l LEFT JOIN documents d ON d.doc_id = l.doc_id AND d.n_chars > 500 "
    "LEFT JOIN labels l2 ON l2.doc_id = l.doc_id",
)
def metadata_defaults(spark, sf):
    """Documents of which some miss their metadata."""
    documents = fx.table(spark, sf, "documents")
    long_ones = documents.where("n_chars > 500").select("doc_id", "lang", "source")
    labels = fx.table(spark, sf, "labels").select("doc_id", "quality")
    rows = documents.select("doc_id").join(long_ones, "doc_id", "left").join(labels, "doc_id", "left")
    return docs.metadata_defaults(rows, ["lang", "source", "quality"])


@query(
    "redact_instructions",
    sql(f"SELECT doc_id, {redact('content')} AS content FROM redaction"),
)
def redact(spark, sf):
    return redact_instructions(fx.derive(fx.table(spark, sf, "documents"), fx.REDACTION))


@query(
    "embed_documents",
    sql("SELECT doc_id, 768 AS dimensions, CAST(1.0 AS DOUBLE) AS norm FROM docs"),
)
def embed_documents(spark, sf):
    """Every document gets 768 dimensions and unit length; the values are hashes."""
    embedded = vectors.embed_documents(fx.document_table(spark, sf))
    square = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    return embedded.select(
        "doc_id", F.size("embedding").alias("dimensions"), F.round(F.sqrt(square), 6).alias("norm")
    )


TOP5 = """
  SELECT request_id, doc_id, distance, CAST(pick AS INTEGER) AS match_rank FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY distance DESC, doc_id) AS pick
    FROM (
      SELECT q.vec_id AS request_id, d.vec_id AS doc_id,
        round(list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 6)
          AS distance
      FROM embeddings q CROSS JOIN embeddings d) pairs) ranked
  WHERE pick <= 5"""


def _questions(spark, sf):
    return fx.embeddings(spark, sf).withColumnRenamed("doc_id", "request_id")


@query("vector_top_k", TOP5)
def vector_top_k(spark, sf):
    """Every vector asks for its five nearest among all."""
    return vectors.vector_top_k(_questions(spark, sf), fx.embeddings(spark, sf), 5)


@query("vector_pairs", TOP5)
def vector_pairs(spark, sf):
    """The same with so few questions in a block that each task goes through several."""
    return vectors.vector_top_k(
        _questions(spark, sf), fx.embeddings(spark, sf), 5, block=200
    )


@query(
    "top_k_matches",
    TOP5.replace("pick <= 5", "pick <= 1 + request_id % 20"),
)
def top_k_matches(spark, sf):
    """Each question with its own k between 1 and 20."""
    matches = vectors.vector_top_k(_questions(spark, sf), fx.embeddings(spark, sf), 20)
    return matches.where(F.col("match_rank") <= 1 + F.col("request_id") % 20)


def _cells(spark, sf):
    """The index of all vectors, saved and read back."""
    path = work_folder(spark, "cells")
    vectors.VectorLeaves.build(fx.embeddings(spark, sf)).save(path)
    return vectors.VectorLeaves.load(spark, path)


@query("vector_top_k_cells")
def vector_top_k_cells(spark, sf):
    return _cells(spark, sf).search(_questions(spark, sf), 5)


@query("vector_cells_all", TOP5)
def vector_cells_all(spark, sf):
    """With every leaf visited the pruned search is exact."""
    return _cells(spark, sf).search(
        _questions(spark, sf), 5, searched=1.0, doc_block=64, question_block=256
    )


@query("vector_recall")
def vector_recall(spark, sf):
    """Recall of the pruned search, the share of leaves it visits, and recall at the least share."""
    exact = materialise(
        vectors.vector_top_k(_questions(spark, sf), fx.embeddings(spark, sf), 5), "exact"
    )
    leaves = _cells(spark, sf)
    least = vectors.recall(leaves.search(_questions(spark, sf), 5, LEAVES_SEARCHED), exact)
    found = vectors.recall(leaves.search(_questions(spark, sf), 5), exact)
    return found.select(
        "*",
        F.lit(leaves.searched).alias("searched"),
        least.select("recall").scalar().alias("recall_at_least_share"),
    )
