"""Retrieval documents and vectors as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.operators.documents import latest_per_doc
from flightlake.schemas import RAG_DOCUMENTS, VECTORS

DOCUMENT_FILE_COLUMNS = [
    "doc_id",
    "content",
    "source_type",
    "airline",
    "route",
    "event_date",
    "metadata",
]


def write_rag_docs(documents: DataFrame, root: str, run_date: str) -> None:
    """Documents of one run as JSON lines below ``date=D``."""
    (
        documents.select(*DOCUMENT_FILE_COLUMNS)
        .write.mode("overwrite")
        .json(f"{root}/rag_docs/date={run_date}")
    )


def read_rag_docs(spark: SparkSession, root: str) -> DataFrame:
    schema = T.StructType([RAG_DOCUMENTS[name] for name in DOCUMENT_FILE_COLUMNS])
    return spark.read.schema(schema).json(f"{root}/rag_docs/date=*/*.json")


def write_vectors(documents: DataFrame, root: str) -> None:
    """``{id, embedding}`` JSON lines in one flat folder."""
    (
        documents.select(F.col("doc_id").cast("string").alias("id"), "embedding")
        .write.mode("overwrite")
        .json(f"{root}/vectors")
    )


def read_vectors(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(VECTORS).json(f"{root}/vectors")


def staged_rows(spark: SparkSession, path: str) -> DataFrame:
    """JSON rows under the document table's schema; a row without a required field fails.

    JSON readers treat every field as optional, so the required ones are
    asserted in the plan rather than by a staging table.
    """
    rows = spark.read.schema(RAG_DOCUMENTS).json(path)
    checked = [
        F.coalesce(
            F.col(field.name),
            F.raise_error(F.lit(f"required field is missing: {field.name}")).cast(field.dataType),
        ).alias(field.name)
        if not field.nullable
        else F.col(field.name)
        for field in RAG_DOCUMENTS
    ]
    return rows.select(*checked)


def write_rag_table(documents: DataFrame, path: str) -> None:
    """The document table: declared columns, order and types, nothing else."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RAG_DOCUMENTS]
    documents.select(*columns).write.mode("overwrite").parquet(path)


def read_rag_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAG_DOCUMENTS).parquet(path)


def merge_into(rows: DataFrame, table: str) -> None:
    """The same merge as one statement, for a table format with row-level changes."""
    source = latest_per_doc(rows, ["content"]).alias("source")
    (
        source.mergeInto(table, F.expr(f"{table}.doc_id = source.doc_id"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
