"""Sources and sinks: rows written to the work folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import sql
from flightlake.operators import documents as docs
from flightlake.operators.vectors import embed_documents
from flightlake.plans import medallion
from flightlake.session import work_folder
from flightlake.sources import bronze, runlog, tables
from flightlake.sources import documents as document_files


def _landed(spark, sf) -> str:
    """Raw flights landed below their event day."""
    root = work_folder(spark, "bronze")
    rows = fx.flights_text(spark, sf).withColumn("date", F.substring("event_ts", 1, 10))
    bronze.write_bronze(rows, root)
    return root


@query(
    "write_bronze",
    sql("SELECT *, CAST(substring(event_ts, 1, 10) AS DATE) AS date FROM raw_text"),
)
def write_bronze(spark, sf):
    """Every landed field and its day, read through the day folders."""
    landed = spark.read.option("header", True).csv(f"{_landed(spark, sf)}/raw")
    return landed.withColumn("date", F.col("date").cast("date"))


@query("read_bronze", sql("SELECT * FROM raw_text"))
def read_bronze(spark, sf):
    return bronze.read_bronze(spark, _landed(spark, sf))


def _silver_table(spark, sf) -> str:
    name = f"silver_{uuid.uuid4().hex}"
    medallion.bronze_to_silver(spark, _landed(spark, sf), name, work_folder(spark, "silver"))
    return name


def _gold_table(spark, silver_name: str) -> str:
    name = f"gold_{uuid.uuid4().hex}"
    medallion.silver_to_gold(spark, silver_name, name, work_folder(spark, "gold"), fx.NOW)
    return name


@query("write_silver", sql("SELECT * FROM silver"))
def write_silver(spark, sf):
    """Files to Silver table, read back by name."""
    return tables.read_table(spark, _silver_table(spark, sf))


@query("write_gold", sql("SELECT * FROM gold"))
def write_gold(spark, sf):
    return tables.read_table(spark, _gold_table(spark, _silver_table(spark, sf)))


@query(
    "read_table",
    sql("SELECT ingest_date, count(*) AS flights FROM silver GROUP BY ingest_date"),
)
def read_table(spark, sf):
    silver = tables.read_table(spark, _silver_table(spark, sf))
    return silver.groupBy("ingest_date").agg(F.count("*").alias("flights"))


@query("export_flat", sql("SELECT * FROM silver"))
def export_flat(spark, sf):
    path = work_folder(spark, "export")
    medallion.export_tables(spark, {_silver_table(spark, sf): path})
    return spark.read.parquet(path)


@query("silver_ext", sql("SELECT * FROM silver"))
def silver_ext(spark, sf):
    path = work_folder(spark, "export")
    tables.export_flat(spark, _silver_table(spark, sf), path)
    return tables.silver_ext(spark, path)


@query("gold_ext", sql("SELECT * FROM gold"))
def gold_ext(spark, sf):
    path = work_folder(spark, "export")
    tables.export_flat(spark, _gold_table(spark, _silver_table(spark, sf)), path)
    return tables.gold_ext(spark, path)


@query(
    "write_rag_docs",
    sql("SELECT doc_id, content, source_type, airline, route, event_date, metadata FROM doc_rows"),
)
def write_rag_docs(spark, sf):
    root = work_folder(spark, "docs")
    rows = docs.rag_documents(fx.flights_text(spark, sf))
    document_files.write_rag_docs(rows, root, fx.AS_OF.isoformat())
    return document_files.read_rag_docs(spark, root)


@query(
    "write_vectors",
    "SELECT id, CAST(place AS BIGINT) AS place, round(CAST(embedding[place] AS DOUBLE), 6) AS value "
    "FROM (SELECT CAST(vec_id AS VARCHAR) AS id, embedding, unnest(range(1, len(embedding) + 1)) AS place "
    "FROM embeddings) places",
)
def write_vectors(spark, sf):
    """Every number of every vector."""
    root = work_folder(spark, "vectors")
    document_files.write_vectors(fx.embeddings(spark, sf), root)
    return document_files.read_vectors(spark, root).select(
        "id", F.posexplode("embedding").alias("place", "value")
    ).select("id", (F.col("place") + 1).cast("bigint").alias("place"), F.round("value", 6).alias("value"))


@query("stage_rows", sql("SELECT * FROM docs"))
def stage_rows(spark, sf):
    path = work_folder(spark, "staging")
    fx.write_json(fx.document_table(spark, sf), path)
    return document_files.staged_rows(spark, path).drop("embedding")


@query("rag_table", sql("SELECT *, 768 AS dimensions FROM docs"))
def rag_table(spark, sf):
    """Embedded documents under the table's schema."""
    path = work_folder(spark, "documents")
    document_files.write_rag_table(embed_documents(fx.document_table(spark, sf)), path)
    table = document_files.read_rag_table(spark, path)
    return table.withColumn("dimensions", F.size("embedding")).drop("embedding")


def _log_folder(spark, sf, file_format="parquet") -> str:
    path = work_folder(spark, "log")
    runlog.write_run_log(fx.run_log(spark, sf), path, file_format)
    return path


LOG_COUNTS = "SELECT CAST(log_ts AS DATE) AS log_date, event, count(*) AS entries FROM {} GROUP BY 1, 2"


def _by_event(log):
    return log.groupBy("log_date", "jsonPayload.event").agg(F.count("*").alias("entries"))


@query("read_run_log", sql(LOG_COUNTS.format("kept_log")))
def read_run_log(spark, sf):
    return _by_event(runlog.read_run_log(spark, _log_folder(spark, sf), fx.LOG_NOW))


@query("write_run_log", sql(LOG_COUNTS.format("log")))
def write_run_log(spark, sf):
    path = _log_folder(spark, sf, "json")
    return _by_event(runlog.read_run_log(spark, path, fx.LOG_NOW, 400, "json"))


@query(
    "read_sample",
    "SELECT CAST(o_orderkey AS VARCHAR) AS flight_id, o_orderstatus AS aircraft_type, "
    "CAST(o_custkey AS INTEGER) AS passenger_count, o_orderdate AS departure_time, "
    "CAST(NULL AS VARCHAR) AS origin, o_orderpriority AS destination, "
    "o_orderdate + INTERVAL 3 HOUR AS arrival_time FROM orders",
)
def read_sample(spark, sf):
    """Orders dressed as the second flight layout."""
    path = work_folder(spark, "sample")
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("flight_id"),
        F.lit(None).cast("string").alias("origin"),
        F.col("o_orderpriority").alias("destination"),
        F.date_format("o_orderdate", iso).alias("departure_time"),
        F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 3 HOURS"), iso).alias("arrival_time"),
        F.col("o_orderstatus").alias("aircraft_type"),
        F.col("o_custkey").alias("passenger_count"),
    ).write.option("header", True).csv(path)
    return bronze.read_sample(spark, path)
