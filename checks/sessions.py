"""Session memory and request-log reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import rnd, sql
from flightlake.functions.times import retained_from
from flightlake.operators import logs, sessions
from flightlake.schemas import VARIANT_LOG
from flightlake.session import work_folder
from flightlake.sources import runlog


@query("last_turns", sql("SELECT session_id, entry_no, role, content FROM last_entries"))
def last_turns(spark, sf):
    kept = sessions.last_turns(fx.entries(spark, sf), fx.MAX_ENTRIES)
    return kept.select("session_id", "entry_no", "role", "content")


HISTORY = """
  SELECT session_id, string_agg(role || ':' || content, '|' ORDER BY entry_no) AS turns,
    CAST(count(*) // 2 AS INTEGER) AS history_turns
  FROM last_entries GROUP BY session_id"""


def _joined():
    return F.array_join(F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["content"])), "|")


@query("session_history", sql(HISTORY))
def session_history(spark, sf):
    history = sessions.session_history(fx.entries(spark, sf), fx.MAX_ENTRIES)
    return history.withColumn("turns", _joined())


TOKENS = """
  SELECT session_id, CAST(coalesce(sum(prompt_tokens), 0) AS BIGINT) AS prompt_tokens,
    CAST(coalesce(sum(response_tokens), 0) AS BIGINT) AS response_tokens,
    CAST(coalesce(sum(total_tokens), 0) AS BIGINT) AS total_tokens,
    count(total_tokens) AS request_count
  FROM all_entries GROUP BY session_id"""
EXPIRY = """SELECT session_id, max(entry_ts) + INTERVAL 3600 SECOND AS expire_at
  FROM all_entries GROUP BY session_id"""


@query("session_tokens", sql(TOKENS))
def session_tokens(spark, sf):
    return sessions.session_tokens(fx.entries(spark, sf))


@query(
    "session_expiry",
    sql(f"SELECT * FROM ({EXPIRY}) e WHERE expire_at > TIMESTAMP '2024-01-31 06:00:00'"),
)
def session_expiry(spark, sf):
    return sessions.live_sessions(fx.entries(spark, sf), fx.NOW)


@query(
    "session_clear",
    sql(
        "SELECT session_id, entry_no FROM all_entries WHERE session_id NOT IN "
        "(SELECT session_id FROM requests WHERE starts_with(question, 'Which airline is worst?'))"
    ),
)
def session_clear(spark, sf):
    """Sessions that asked for the worst airline are cleared."""
    cleared = fx.requests(spark, sf).where(F.col("question").startswith("Which airline is worst?"))
    return sessions.clear_sessions(fx.entries(spark, sf), cleared).select("session_id", "entry_no")


SESSION_DOCUMENTS = f"""
  SELECT t.session_id, h.turns, t.prompt_tokens, t.response_tokens, t.total_tokens,
    t.request_count, e.expire_at
  FROM ({TOKENS}) t JOIN ({HISTORY}) h ON h.session_id = t.session_id
  JOIN ({EXPIRY}) e ON e.session_id = t.session_id"""


@query("session_documents", sql(SESSION_DOCUMENTS))
def session_documents(spark, sf):
    documents = sessions.session_documents(fx.entries(spark, sf), fx.MAX_ENTRIES)
    return documents.withColumn("turns", _joined()).drop("history_turns")


# --- request log ---


def _kept(spark, sf):
    log = fx.run_log(spark, sf)
    return log.where(F.col("log_date") >= F.lit(retained_from(fx.LOG_NOW, 30)))


@query(
    "log_export_filter",
    sql(
        "SELECT log_ts AS timestamp, severity, event, session_id FROM log "
        "WHERE event IN ('token_usage', 'guardrail_triggered', 'bq_fallback')"
    ),
)
def log_export_filter(spark, sf):
    kept = logs.log_export_filter(fx.run_log(spark, sf))
    return kept.select("timestamp", "severity", "jsonPayload.event", "jsonPayload.session_id")


@query("token_usage_rows", sql("SELECT * FROM usage"))
def token_usage_rows(spark, sf):
    return logs.token_usage_rows(_kept(spark, sf))


@query("guardrail_rows", sql("SELECT * FROM guardrails"))
def guardrail_rows(spark, sf):
    return logs.guardrail_rows(_kept(spark, sf))


def _tokens_sql(grain: str) -> str:
    return sql(
        f"SELECT endpoint, CAST(date_trunc('{grain}', hour) AS DATE) AS {grain}, "
        "CAST(sum(prompt_tokens) AS BIGINT) AS prompt_tokens, "
        "CAST(sum(response_tokens) AS BIGINT) AS response_tokens, "
        "CAST(sum(total_tokens) AS BIGINT) AS total_tokens FROM usage GROUP BY 1, 2"
    )


@query("tokens_by_endpoint", _tokens_sql("day"))
def tokens_by_endpoint(spark, sf):
    return logs.tokens_by_endpoint(logs.token_usage_rows(_kept(spark, sf)))


@query("tokens_by_endpoint_week", _tokens_sql("week"))
def tokens_by_endpoint_week(spark, sf):
    return logs.tokens_by_endpoint(logs.token_usage_rows(_kept(spark, sf)), "week")


@query(
    "top_sessions",
    sql(
        "SELECT session_id, CAST(sum(total_tokens) AS BIGINT) AS total_tokens FROM usage "
        "GROUP BY session_id ORDER BY total_tokens DESC, session_id LIMIT 10"
    ),
)
def top_sessions(spark, sf):
    return logs.top_sessions(logs.token_usage_rows(_kept(spark, sf)))


@query(
    "rejections_by_type",
    sql(
        "SELECT guardrail_type, count(*) AS rejections FROM guardrails "
        "WHERE event_type = 'guardrail_triggered' GROUP BY guardrail_type"
    ),
)
def rejections_by_type(spark, sf):
    return logs.rejections_by_type(logs.guardrail_rows(_kept(spark, sf)))


@query(
    "rejections_by_hour",
    sql(
        "SELECT guardrail_type, hour, count(*) AS rejections FROM guardrails "
        "WHERE event_type = 'guardrail_triggered' GROUP BY guardrail_type, hour"
    ),
)
def rejections_by_hour(spark, sf):
    return logs.rejections_by_type(logs.guardrail_rows(_kept(spark, sf)), hourly=True)


FALLBACK_RATE = sql(
    f"""
    SELECT requests, fallbacks,
      {rnd('CAST(fallbacks AS DOUBLE) / nullif(requests, 0)', 6)} AS fallback_rate
    FROM (SELECT count(*) FILTER (WHERE event = 'token_usage' AND endpoint = '/retrieve')
            AS requests,
          count(*) FILTER (WHERE event = 'bq_fallback' AND vs_results < 3) AS fallbacks
          FROM kept_log) n"""
)


@query("fallback_rate", FALLBACK_RATE)
def fallback_rate(spark, sf):
    return logs.fallback_rate(_kept(spark, sf))


# --- the same reports from a log whose payload is a variant ---


def _variant_kept(spark, sf):
    """Written as JSON lines and read back, days outside the retention left unread."""
    path = work_folder(spark, "variant-log")
    runlog.write_run_log(fx.variant_log(spark, sf), path, "json")
    return runlog.read_run_log(spark, path, fx.LOG_NOW, 30, "json", VARIANT_LOG)


@query("variant_token_usage", sql("SELECT * FROM usage"))
def variant_token_usage(spark, sf):
    return logs.token_usage_rows(_variant_kept(spark, sf))


@query("variant_guardrails", sql("SELECT * FROM guardrails"))
def variant_guardrails(spark, sf):
    return logs.guardrail_rows(_variant_kept(spark, sf))


@query("variant_fallback_rate", FALLBACK_RATE)
def variant_fallback_rate(spark, sf):
    return logs.fallback_rate(_variant_kept(spark, sf))


def _field_counts() -> str:
    text, whole = ("event", "session_id", "endpoint", "guardrail_type", "reason"), (
        "prompt_tokens", "response_tokens", "total_tokens", "vs_results")
    kinds = {name: ("string", "true") for name in text} | {name: ("bigint", "true") for name in whole}
    kinds |= {"model": ("string", "false"), "latency_ms": ("bigint", "false"), "cached": ("boolean", "false")}
    counts = [
        f"SELECT event, '{name}' AS field, '{kind}' AS type, {known} AS known, count({name}) AS entries "
        "FROM free_log GROUP BY event"
        for name, (kind, known) in kinds.items()
    ]
    return (
        f"WITH free_log AS ({fx.select_sql(fx.RUN_LOG | fx.FREE_FIELDS, 'events')}) "
        f"SELECT * FROM ({' UNION ALL '.join(counts)}) c WHERE entries > 0"
    )


@query("log_fields", _field_counts())
def log_fields(spark, sf):
    return logs.log_fields(fx.variant_log(spark, sf))


@query(
    "run_tokens",
    sql(
        "SELECT run_id, CAST(coalesce(sum(tokens), 0) AS BIGINT) AS total_tokens "
        "FROM run_events GROUP BY run_id"
    ),
)
def run_tokens(spark, sf):
    return logs.run_tokens(fx.run_events(spark, sf))
