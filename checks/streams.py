"""Continuous jobs run over landed files until none is left, read back as tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sessions import SESSION_DOCUMENTS, _joined
from checks.sql import sql
from checks.storage import _landed, _log_folder
from flightlake.schemas import VARIANT_LOG
from flightlake.session import work_folder
from flightlake.sources import bronze, runlog
from flightlake.sources.document_table import create_document_table, read_document_table
from flightlake.streaming import documents as document_stream
from flightlake.streaming import flights as flight_stream
from flightlake.streaming import logs as log_stream
from flightlake.streaming import sessions as session_stream


@query("stream_bronze_to_silver", sql("SELECT flight_id FROM silver"))
def stream_bronze_to_silver(spark, sf):
    """Which of two duplicates survives depends on arrival, so ids are compared."""
    path = work_folder(spark, "stream-silver")
    flight_stream.stream_bronze_to_silver(
        spark, _landed(spark, sf), path, work_folder(spark, "offsets"), files_per_batch=5
    ).awaitTermination()
    return spark.read.parquet(path).select("flight_id")


@query("stream_silver_exact", sql("SELECT * FROM silver"))
def stream_silver_exact(spark, sf):
    """All files are one batch here, so the batch job's survivors survive."""
    path = work_folder(spark, "stream-silver")
    flight_stream.stream_silver_exact(
        spark, _landed(spark, sf), path, work_folder(spark, "offsets")
    ).awaitTermination()
    return spark.read.parquet(path).drop("batch")


WAVE = "CASE WHEN ingest_date >= DATE '2024-01-21' THEN 0 WHEN ingest_date >= DATE '2024-01-11' THEN 1 ELSE 2 END"


@query(
    "stream_silver_waves",
    sql(
        f"""
        SELECT * EXCLUDE (pick) FROM (
          SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY {WAVE}, event_ts, airline, origin,
            destination, departure_delay_min, arrival_delay_min, status NULLS FIRST,
            weather_flag NULLS FIRST) AS pick
          FROM passing) ranked WHERE pick = 1"""
    ),
)
def stream_silver_waves(spark, sf):
    """Days land in three waves, the latest first; an id keeps the row of its first wave."""
    root, path = work_folder(spark, "bronze"), work_folder(spark, "stream-silver")
    checkpoint = work_folder(spark, "offsets")
    rows = fx.flights_text(spark, sf).withColumn("date", F.substring("event_ts", 1, 10))
    for first, end in (("2024-01-21", "9"), ("2024-01-11", "2024-01-21"), ("", "2024-01-11")):
        bronze.write_bronze(rows.where((F.col("date") >= first) & (F.col("date") < end)), root)
        flight_stream.stream_silver_exact(spark, root, path, checkpoint, buckets=8).awaitTermination()
    return spark.read.parquet(path).drop("batch")


@query(
    "stream_run_log",
    sql(
        "SELECT CAST(log_ts AS DATE) AS log_date, event, count(*) AS entries FROM log "
        "WHERE event IN ('token_usage', 'guardrail_triggered', 'bq_fallback') GROUP BY 1, 2"
    ),
)
def stream_run_log(spark, sf):
    path = work_folder(spark, "stream-log")
    records = log_stream.log_stream(spark, _log_folder(spark, sf, "json"))
    log_stream.stream_run_log(records, path, work_folder(spark, "offsets")).awaitTermination()
    exported = spark.read.parquet(path)
    return exported.groupBy("log_date", "jsonPayload.event").agg(F.count("*").alias("entries"))


HOURLY_TOKENS = sql(
    """
    SELECT date_trunc('hour', log_ts) AS hour, endpoint,
      CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens,
      CAST(sum(response_tokens) AS BIGINT) AS response_tokens,
      CAST(sum(total_tokens) AS BIGINT) AS total_tokens
    FROM log WHERE event = 'token_usage' GROUP BY 1, 2"""
)


@query("stream_hourly_tokens", HOURLY_TOKENS)
def stream_hourly_tokens(spark, sf):
    """All hours, over several micro-batches."""
    path = work_folder(spark, "stream-tokens")
    records = log_stream.log_stream(spark, _log_folder(spark, sf, "json"), files_per_batch=2)
    log_stream.stream_hourly_tokens(
        records, path, work_folder(spark, "offsets")
    ).awaitTermination()
    return log_stream.read_hourly_tokens(spark, path)


@query("state_hourly_tokens", HOURLY_TOKENS)
def state_hourly_tokens(spark, sf):
    """The same sums from the stream's state, over several micro-batches; the stream writes no table."""
    checkpoint = work_folder(spark, "offsets")
    records = log_stream.log_stream(spark, _log_folder(spark, sf, "json"), files_per_batch=2)
    log_stream.keep_hourly_tokens(records, checkpoint).awaitTermination()
    return log_stream.hourly_tokens_state(spark, checkpoint)


@query(
    "stream_variant_log",
    f"WITH free_log AS ({fx.select_sql(fx.RUN_LOG | fx.FREE_FIELDS, 'events')}) "
    "SELECT log_ts AS timestamp, severity, event, session_id, total_tokens, reason, model, latency_ms, cached "
    "FROM free_log WHERE event IN ('token_usage', 'guardrail_triggered', 'bq_fallback')",
)
def stream_variant_log(spark, sf):
    """The export keeps fields that no report knows; every value is compared."""
    source, path = work_folder(spark, "variant-log"), work_folder(spark, "stream-log")
    runlog.write_run_log(fx.variant_log(spark, sf), source, "json")
    records = log_stream.log_stream(spark, source, schema=VARIANT_LOG)
    log_stream.stream_run_log(records, path, work_folder(spark, "offsets")).awaitTermination()
    kinds = {"event": "string", "session_id": "string", "total_tokens": "bigint", "reason": "string",
             "model": "string", "latency_ms": "bigint", "cached": "boolean"}
    fields = [F.variant_get("jsonPayload", f"$.{name}", kind).alias(name) for name, kind in kinds.items()]
    return spark.read.schema(VARIANT_LOG).parquet(path).select("timestamp", "severity", *fields)


@query("state_sessions", sql(SESSION_DOCUMENTS))
def state_sessions(spark, sf):
    """The documents from the stream's state equal the batch job's."""
    source, checkpoint = work_folder(spark, "entries"), work_folder(spark, "offsets")
    fx.entries(spark, sf).write.parquet(source)
    entries = session_stream.entry_stream(spark, source)
    session_stream.keep_sessions(entries, checkpoint, fx.MAX_ENTRIES).awaitTermination()
    return session_stream.session_state(spark, checkpoint).withColumn("turns", _joined())


@query("stream_sessions", sql(SESSION_DOCUMENTS))
def stream_sessions(spark, sf):
    """The newest document of every session equals the batch job's."""
    source, path = work_folder(spark, "entries"), work_folder(spark, "stream-sessions")
    fx.entries(spark, sf).write.parquet(source)
    session_stream.stream_sessions(
        session_stream.entry_stream(spark, source),
        path,
        work_folder(spark, "offsets"),
        fx.MAX_ENTRIES,
    ).awaitTermination()
    documents = spark.read.parquet(path)
    fields = [name for name in documents.columns if name not in ("session_id", "batch")]
    newest = documents.groupBy("session_id").agg(F.max_by(F.struct(*fields), "batch").alias("d"))
    return newest.select("session_id", "d.*").withColumn("turns", _joined())


@query("stream_upsert_docs", sql("SELECT * FROM merged"))
def stream_upsert_docs(spark, sf):
    """The first batch of documents, then the second, each as files that arrive."""
    source, table = work_folder(spark, "arriving"), f"documents_{uuid.uuid4().hex}"
    checkpoint = work_folder(spark, "offsets")
    create_document_table(spark, table, work_folder(spark, "stream-docs"))
    for batch in (fx.document_table(spark, sf), fx.document_batch(spark, sf)):
        fx.write_json(batch, source)
        document_stream.stream_upsert_docs(
            document_stream.document_stream(spark, source), table, checkpoint
        ).awaitTermination()
    return read_document_table(spark, table).drop("embedding")
