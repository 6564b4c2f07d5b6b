"""Question batches: validation, routing, gate, context, answers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.flights import ROUTE_FACTS
from checks.registry import query
from checks.sql import avg, pct, redact, signals, sql
from flightlake.functions import text
from flightlake.operators import requests as req
from flightlake.operators import views
from flightlake.operators.batch_facts import AGENT_AIRLINE, AGENT_RAG, AGENT_ROUTE, RAG_NAMES
from flightlake.operators.documents import metadata_defaults
from flightlake.operators.facts import pair_facts, recent_documents, slowest_pairs
from flightlake.operators.logs import token_usage_rows
from flightlake.operators.sessions import last_turns
from flightlake.operators.vectors import embed_documents
from flightlake.plans import questions
from flightlake.session import materialise
from flightlake.sources.runlog import log_records


@query(
    "validate_requests",
    sql(
        "SELECT request_id, question, session_id, airline, route, days_back, top_k, error "
        "FROM checked"
    ),
)
def validate_requests(spark, sf):
    return req.validate_requests(fx.requests(spark, sf)).drop("conv_id")


@query(
    "route_question",
    sql(
        "SELECT request_id, CASE WHEN length(question) - length(replace(question, '?', '')) > 1 "
        f"OR {signals('question')} THEN 'agent' ELSE 'retrieve' END AS routed_to "
        "FROM clean_requests"
    ),
)
def route_question(spark, sf):
    return req.route_question(fx.requests(spark, sf)).select("request_id", "routed_to")


@query("facts_query_type", sql("SELECT request_id, query_type FROM asked"))
def facts_query_type(spark, sf):
    return questions.accepted(fx.requests(spark, sf)).select("request_id", "query_type")


def _matches(spark, sf):
    """Labelled documents stand in for the matches of a conversation's questions."""
    asked = fx.requests(spark, sf).select("request_id", "conv_id")
    documents = fx.table(spark, sf, "documents").select(
        "doc_id",
        F.col("text").alias("content"),
        F.col("source").alias("source_type"),
        F.lit(None).cast("string").alias("airline"),
        F.col("lang").alias("route"),
        F.lit(None).cast("string").alias("event_date"),
        F.floor(F.col("doc_id") / 10).alias("conv_id"),
        ((100 - 5 * (F.col("doc_id") % 10)).cast("double") / 100).alias("distance"),
    )
    good = fx.table(spark, sf, "labels").where("quality = 1").select("doc_id")
    rows = asked.join(documents.join(good, "doc_id"), "conv_id").drop("conv_id")
    order = Window.partitionBy("request_id").orderBy("doc_id")
    ranked = rows.withColumn("match_rank", F.row_number().over(order))
    return metadata_defaults(ranked, ["airline", "event_date"])


GATE = """
  SELECT r.request_id, coalesce(m.hits, 0) AS vs_results, coalesce(m.hits, 0) < 3 AS needs_facts
  FROM requests r
  LEFT JOIN (SELECT request_id, count(*) AS hits FROM matches GROUP BY request_id) m
    ON m.request_id = r.request_id"""


@query("retrieval_gate", sql(GATE))
def retrieval_gate(spark, sf):
    gated = req.retrieval_gate(fx.requests(spark, sf), _matches(spark, sf))
    return gated.select("request_id", "vs_results", "needs_facts")


@query(
    "first_n_context",
    sql("SELECT request_id, match_rank, doc_id FROM matches WHERE match_rank <= 3"),
)
def first_n_context(spark, sf):
    kept = req.first_n(_matches(spark, sf), "request_id", "match_rank")
    return kept.select("request_id", "match_rank", "doc_id")


FACT_NAMES = ["airline", "route", "flight_count", "weather_pct"]
# the four slowest pairs of an airline serve as facts for the questions of a conversation
FACT_ROWS = """
  SELECT r.request_id, f.airline, f.route, f.flight_count, f.weather_pct, f.fact_rank
  FROM requests r JOIN (
    SELECT *, CAST(row_number() OVER (PARTITION BY airline
      ORDER BY avg_delay_min DESC, route) AS INTEGER) AS fact_rank
    FROM ({pairs}) p) f
    ON f.airline = r.airline"""


def _fact_rows(spark, sf):
    recent = recent_documents(fx.document_table(spark, sf), fx.AS_OF, fx.DAYS)
    ranked = slowest_pairs(pair_facts(recent))
    asked = fx.requests(spark, sf).select("request_id", "airline")
    # an airline is few rows here but many after the join: requests are spread by their own id, and stay so
    spread = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "request_id")
    joined = spread.join(F.broadcast(ranked), "airline")
    return joined.select("request_id", "fact_rank", *FACT_NAMES)


def _fact_sql() -> str:
    from checks.facts import PAIRS

    return FACT_ROWS.format(pairs=f"{PAIRS} GROUP BY airline, route")


FACT_JSON = (
    "'{' || E'\\n' || '  \"airline\": \"' || airline || '\",' || E'\\n' || '  \"route\": \"' || route "
    "|| '\",' || E'\\n' || '  \"flight_count\": ' || CAST(flight_count AS VARCHAR) || ',' || E'\\n' "
    "|| '  \"weather_pct\": ' || CAST(weather_pct AS VARCHAR) || E'\\n' || '}'"
)

HISTORY = f"""
  SELECT session_id, string_agg(CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ': '
    || {redact('content')}, E'\\n' ORDER BY entry_no) AS history_block
  FROM last_entries GROUP BY session_id"""
REFERENCES = f"""
  SELECT request_id, string_agg('[Ref ' || CAST(match_rank AS VARCHAR) || '] ' || source_type
    || ' — ' || airline || ' ' || route || ' (' || event_date || ')' || E'\\n'
    || substring({redact('content')}, 1, 500), E'\\n\\n' ORDER BY match_rank) AS docs_block
  FROM matches WHERE match_rank <= 3 GROUP BY request_id"""


@query(
    "assemble_context",
    sql(
        f"""
        SELECT r.request_id, r.question, coalesce(h.history_block, '(none)') AS history_block,
          coalesce(d.docs_block, '(no vector search results)') AS docs_block,
          coalesce(f.facts_block, '(no BigQuery facts)') AS facts_block
        FROM requests r
        LEFT JOIN ({HISTORY}) h ON h.session_id = r.session_id
        LEFT JOIN ({REFERENCES}) d ON d.request_id = r.request_id
        LEFT JOIN (SELECT request_id, string_agg({FACT_JSON}, E'\\n' ORDER BY fact_rank)
            AS facts_block
          FROM ({_fact_sql()}) x WHERE fact_rank <= 3 GROUP BY request_id) f
          ON f.request_id = r.request_id"""
    ),
)
def assemble_context(spark, sf):
    facts = req.fact_texts(_fact_rows(spark, sf), FACT_NAMES)
    return req.assemble_context(
        fx.requests(spark, sf),
        last_turns(fx.entries(spark, sf), fx.MAX_ENTRIES),
        _matches(spark, sf),
        facts,
    )


@query(
    "citations",
    sql(
        """
        SELECT request_id, count(*) AS cited,
          string_agg(CAST(doc_id AS VARCHAR) || ' ' || source_type || ' ' || route || ' '
            || CAST(CAST(distance AS DECIMAL(18,2)) AS VARCHAR), ';' ORDER BY match_rank) AS listed
        FROM matches WHERE match_rank <= 20 GROUP BY request_id"""
    ),
)
def citations(spark, sf):
    cited = req.citations(_matches(spark, sf))
    entry = F.transform(
        "sources",
        lambda c: F.concat_ws(
            " ",
            c["doc_id"].cast("string"),
            c["source_type"],
            c["route"],
            c["similarity"].cast("decimal(18,2)").cast("string"),
        ),
    )
    return cited.select(
        "request_id",
        F.size("sources").cast("bigint").alias("cited"),
        F.array_join(entry, ";").alias("listed"),
    )


@query(
    "tools_used",
    sql(
        f"""
        SELECT g.request_id, CASE WHEN vs_results > 0 THEN 'vector_search,' ELSE '' END
          || CASE WHEN needs_facts AND r.airline IS NOT NULL THEN 'bigquery_fallback,' ELSE '' END
          || 'gemini_2.5_flash' AS tools
        FROM ({GATE}) g JOIN requests r ON r.request_id = g.request_id"""
    ),
)
def tools_used(spark, sf):
    gated = req.retrieval_gate(fx.requests(spark, sf), _matches(spark, sf))
    counted = gated.select(
        "request_id",
        F.col("vs_results").alias("context_count"),
        (F.col("needs_facts") & F.col("airline").isNotNull()).cast("int").alias("facts_count"),
    )
    return req.tools_used(counted).select(
        "request_id", F.array_join("tools_used", ",").alias("tools")
    )


@query(
    "first_fact",
    sql(
        f"SELECT request_id, airline, route, flight_count, weather_pct FROM ({_fact_sql()}) x "
        "WHERE fact_rank = 1"
    ),
)
def first_fact(spark, sf):
    return req.first_fact(_fact_rows(spark, sf)).drop("fact_rank")


@query(
    "fallback_answer",
    sql(
        f"""
        SELECT r.request_id, CASE WHEN f.request_id IS NULL
          THEN 'No matching data was found for the requested filters in the selected time window.'
          ELSE 'Deterministic response for ''' || r.question || ''': airline=' || f.airline
            || ', route=' || f.route || ', flight_count=' || CAST(f.flight_count AS VARCHAR)
            || ', weather_pct=' || CAST(f.weather_pct AS VARCHAR) || '.' END AS answer
        FROM requests r LEFT JOIN (SELECT * FROM ({_fact_sql()}) x WHERE fact_rank = 1) f
          ON f.request_id = r.request_id"""
    ),
)
def fallback_answer(spark, sf):
    facts = req.with_fact_pairs(_fact_rows(spark, sf), FACT_NAMES)
    return req.fallback_answer(fx.requests(spark, sf), facts).select("request_id", "answer")


@query(
    "answered_entries",
    """
    SELECT concat('s-', CAST(conv_id AS VARCHAR)) AS session_id, 2 * turn + part AS entry_no,
      CASE part WHEN 0 THEN 'user' ELSE 'assistant' END AS role,
      CASE part WHEN 0 THEN 'q ' || text ELSE 'a ' || text END AS content,
      CASE part WHEN 0 THEN NULL ELSE length(text) END AS total_tokens
    FROM conversations, (VALUES (0), (1)) parts(part) WHERE role <> 'system'""",
)
def answered_entries(spark, sf):
    """Every turn as an answered request; system turns belong to no session."""
    session = F.concat(F.lit("s-"), F.col("conv_id").cast("string"))
    answers = fx.table(spark, sf, "conversations").select(
        F.when(F.col("role") != "system", session).alias("session_id"),
        F.col("turn").alias("turn_no"),
        F.lit(fx.NOW).alias("asked_at"),
        F.concat(F.lit("q "), "text").alias("question"),
        F.concat(F.lit("a "), "text").alias("answer"),
        F.lit(0).alias("prompt_tokens"),
        F.lit(0).alias("response_tokens"),
        F.length("text").alias("total_tokens"),
    )
    entries = req.answered_entries(answers)
    return entries.select("session_id", "entry_no", "role", "content", "total_tokens")


@query(
    "request_log",
    sql(
        f"""
        SELECT 'INFO' AS severity, 'router_decision' AS event,
          coalesce(session_id, 'anonymous') AS session_id, NULL AS reason,
          CAST(NULL AS BIGINT) AS vs_results,
          CASE WHEN length(question) - length(replace(question, '?', '')) > 1
            OR {signals('question')} THEN 'agent' ELSE 'retrieve' END AS route,
          length(question) AS question_length
        FROM checked
        UNION ALL
        SELECT 'WARNING', 'guardrail_triggered', coalesce(session_id, 'anonymous'), error, NULL,
          NULL, NULL
        FROM checked WHERE error IS NOT NULL
        UNION ALL
        SELECT 'INFO', 'bq_fallback', coalesce(c.session_id, 'anonymous'), NULL, g.vs_results,
          NULL, NULL
        FROM ({GATE}) g JOIN checked c ON c.request_id = g.request_id WHERE g.needs_facts"""
    ),
)
def request_log(spark, sf):
    checked = req.validate_requests(fx.requests(spark, sf)).withColumn("asked_at", F.lit(fx.NOW))
    log = req.request_log(checked, req.retrieval_gate(checked, _matches(spark, sf)))
    return log.select(
        "severity", "event", "session_id", "reason", "vs_results", "route", "question_length"
    )


@query(
    "batch_token_usage",
    sql(
        f"""
        SELECT coalesce(session_id, 'anonymous') AS session_id,
          CASE WHEN length(question) - length(replace(question, '?', '')) > 1
            OR {signals('question')} THEN '/agent' ELSE '/retrieve' END AS endpoint,
          CAST(length(question) AS BIGINT) AS prompt_tokens, CAST(top_k AS BIGINT) AS response_tokens,
          CAST(length(question) + top_k AS BIGINT) AS total_tokens
        FROM checked WHERE error IS NULL"""
    ),
)
def batch_token_usage(spark, sf):
    """Token rows of the log that a batch writes; lengths stand in for a model's counts."""
    checked = req.validate_requests(fx.requests(spark, sf)).withColumn("asked_at", F.lit(fx.NOW))
    answers = req.route_question(checked.where("error IS NULL")).withColumns(
        {
            "endpoint": F.concat(F.lit("/"), "routed_to"),
            "prompt_tokens": F.length("question"),
            "response_tokens": F.col("top_k"),
            "total_tokens": F.length("question") + F.col("top_k"),
        }
    )
    log = req.request_log(checked, req.retrieval_gate(checked, _matches(spark, sf)), answers)
    return token_usage_rows(log_records(log)).drop("timestamp", "hour")


@query(
    "flatten_content",
    "SELECT doc_id, coalesce(lang, '') || ' ' || coalesce(source, '') || ' ' || coalesce(text, '') "
    "AS content FROM documents",
)
def flatten_content(spark, sf):
    parts = F.array(*[F.struct(F.col(c).alias("text")) for c in ("lang", "source", "text")])
    documents = fx.table(spark, sf, "documents")
    return documents.select("doc_id", text.flatten_parts(parts).alias("content"))


@query(
    "resource_names",
    "SELECT page_id, coalesce(regexp_extract(url, '[^/]*$'), '') AS resource_id FROM pages",
)
def resource_names(spark, sf):
    pages = fx.table(spark, sf, "pages")
    return pages.select("page_id", text.last_segment(F.col("url")).alias("resource_id"))


@query(
    "truthy_words",
    "SELECT event_id, lower(trim(CASE event_id % 8 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'Yes' "
    "WHEN 2 THEN '1' WHEN 3 THEN 'off' WHEN 4 THEN 'on' WHEN 5 THEN '' WHEN 6 THEN 't' "
    "ELSE event_type END)) IN ('1', 'true', 't', 'yes', 'y', 'on') AS flag FROM events",
)
def truthy_words(spark, sf):
    written = F.expr(
        "CASE event_id % 8 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'Yes' WHEN 2 THEN '1' "
        "WHEN 3 THEN 'off' WHEN 4 THEN 'on' WHEN 5 THEN '' WHEN 6 THEN 't' ELSE event_type END"
    )
    return fx.table(spark, sf, "events").select("event_id", text.truthy(written).alias("flag"))


def _embedded(spark, sf):
    return embed_documents(fx.document_table(spark, sf))


@query("search_flight_records")
def search_flight_records(spark, sf):
    """Valid questions against all flight documents; hashed vectors have no SQL twin."""
    return questions.search_requests(
        questions.accepted(fx.requests(spark, sf)), _embedded(spark, sf)
    )


def _json_sql(names: list[str], texts: set[str]) -> str:
    lines = []
    for name in names:
        value = f"CAST({name} AS VARCHAR)"
        shown = f"'\"' || {name} || '\"'" if name in texts else value
        lines.append(f"'  \"{name}\": ' || {shown}")
    return "'{' || E'\\n' || " + " || ',' || E'\\n' || ".join(lines) + " || E'\\n' || '}'"


PAIRS_SHOWN = " || ', ' || ".join(f"'{n}=' || CAST({n} AS VARCHAR)" for n in RAG_NAMES)


@query(
    "answer_contexts",
    sql(
        f"""
        SELECT a.request_id, a.question, coalesce(h.history_block, '(none)') AS history_block,
          coalesce(f.facts_block, '(no BigQuery facts)') AS facts_block,
          coalesce('Deterministic response for ''' || a.question || ''': ' || f.pairs || '.',
            'No matching data was found for the requested filters in the selected time window.')
            AS answer,
          a.session_id, CASE WHEN length(a.question) - length(replace(a.question, '?', '')) > 1
            OR {signals('a.question')} THEN 'agent' ELSE 'retrieve' END AS routed_to,
          CAST(a.top_k AS BIGINT) AS context_count,
          coalesce(f.facts_count, 0) AS facts_count,
          coalesce(h.entries // 2, 0) AS history_turns,
          'vector_search,' || CASE WHEN f.facts_count > 0 THEN 'bigquery_fallback,' ELSE '' END
            || 'gemini_2.5_flash' AS tools_used
        FROM asked a
        LEFT JOIN (
          SELECT session_id, count(*) AS entries, string_agg(
            CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ': ' || {redact('content')},
            E'\\n' ORDER BY entry_no) AS history_block
          FROM all_entries GROUP BY session_id) h ON h.session_id = a.session_id
        LEFT JOIN (
          SELECT request_id, count(*) AS facts_count,
            string_agg({_json_sql(RAG_NAMES, {'airline', 'route'})}, E'\\n' ORDER BY pick)
              FILTER (WHERE pick <= 3) AS facts_block,
            max({PAIRS_SHOWN}) FILTER (WHERE pick = 1) AS pairs
          FROM (SELECT *, row_number() OVER (PARTITION BY request_id
                  ORDER BY avg_delay_min DESC, airline, route) AS pick FROM asked_pairs) ranked
          WHERE pick <= 10 GROUP BY request_id) f
          ON f.request_id = a.request_id AND a.top_k < 3"""
    ),
)
def answer_contexts(spark, sf):
    """The whole batch: checked, searched, gated, assembled.

    Which documents are found depends on hashed vectors, so references and
    citations are left out here; every question finds as many as it asks for.
    """
    silver = fx.silver(spark, sf)
    contexts = questions.answer_contexts(
        fx.requests(spark, sf),
        fx.entries(spark, sf),
        _embedded(spark, sf),
        silver,
        views.route_risk(silver),
        fx.AS_OF,
    )
    return contexts.drop("docs_block", "sources").withColumns(
        {
            "tools_used": F.array_join("tools_used", ","),
            "history_turns": F.col("history_turns").cast("bigint"),
        }
    )


def _fact_texts(names: list[str], rows: str, order: str) -> str:
    """The ten first facts of each request, as text."""
    pairs = " || ', ' || ".join(f"'{n}=' || CAST({n} AS VARCHAR)" for n in names)
    return f"""SELECT request_id, pick, {_json_sql(names, {'airline', 'route'})} AS fact_json,
            {pairs} AS fact_pairs
          FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY {order}) AS pick
            FROM ({rows}) facts) ranked WHERE pick <= 10"""


#: The two reports that agent questions name here; a question without such rows asks the documents.
AGENT_REPORTS = " UNION ALL ".join(
    [
        _fact_texts(
            AGENT_AIRLINE,
            f"""SELECT r.request_id, s.airline, count(*) AS flight_count,
              {avg('s.departure_delay_min', 1)} AS avg_delay_min,
              {pct('s.departure_delay_min > 15')} AS delayed_pct, {pct('s.weather_flag')} AS weather_pct
            FROM directed r JOIN silver s ON s.ingest_date >= DATE '2024-01-31' - r.days_back
              AND (r.airline IS NULL OR r.airline = s.airline)
            WHERE r.routed_to = 'agent' AND r.query_type = 'airline' GROUP BY 1, 2""",
            "avg_delay_min DESC, airline",
        ),
        _fact_texts(
            AGENT_ROUTE,
            f"""SELECT r.request_id, f.* FROM directed r
            JOIN ({ROUTE_FACTS}) f ON r.route IS NULL OR r.route = f.route
            WHERE r.routed_to = 'agent' AND r.query_type = 'route_risk'""",
            "avg_risk_score DESC, route",
        ),
    ]
)
AGENT_DOCUMENTS = _fact_texts(
    AGENT_RAG,
    f"""SELECT * RENAME (weather_impact_pct AS weather_pct) FROM asked_pairs
    WHERE request_id IN (SELECT request_id FROM directed WHERE routed_to = 'agent')
      AND request_id NOT IN (SELECT request_id FROM ({AGENT_REPORTS}) named)""",
    "avg_delay_min DESC, airline, route",
)
RETRIEVED_FACTS = _fact_texts(
    RAG_NAMES,
    """SELECT * FROM asked_pairs WHERE request_id IN (
      SELECT request_id FROM directed WHERE routed_to = 'retrieve' AND top_k < 3)""",
    "avg_delay_min DESC, airline, route",
)


@query(
    "ask_batch",
    sql(
        f"""
        SELECT a.request_id, a.question, coalesce(h.history_block, '(none)') AS history_block,
          coalesce(f.facts_block, '(no BigQuery facts)') AS facts_block,
          coalesce('Deterministic response for ''' || a.question || ''': ' || f.pairs || '.',
            'No matching data was found for the requested filters in the selected time window.')
            AS answer,
          a.session_id, a.routed_to, CAST(a.top_k AS BIGINT) AS context_count,
          coalesce(f.facts_count, 0) AS facts_count,
          coalesce(h.entries // 2, 0) AS history_turns,
          'vector_search,' || CASE WHEN f.facts_count > 0 THEN 'bigquery_fallback,' ELSE '' END
            || 'gemini_2.5_flash' AS tools_used
        FROM directed a
        LEFT JOIN (
          SELECT session_id, count(*) AS entries, string_agg(
            CASE WHEN role = 'user' THEN 'User' ELSE 'Assistant' END || ': ' || {redact('content')},
            E'\\n' ORDER BY entry_no) AS history_block
          FROM all_entries GROUP BY session_id) h ON h.session_id = a.session_id
        LEFT JOIN (
          SELECT request_id, count(*) AS facts_count,
            string_agg(fact_json, E'\\n' ORDER BY pick) FILTER (WHERE pick <= 3) AS facts_block,
            max(fact_pairs) FILTER (WHERE pick = 1) AS pairs
          FROM ({AGENT_REPORTS} UNION ALL {AGENT_DOCUMENTS} UNION ALL {RETRIEVED_FACTS}) told
          GROUP BY request_id) f ON f.request_id = a.request_id"""
    ),
)
def ask_batch(spark, sf):
    """The router: both paths and both orders of facts; references as in ``answer_contexts``."""
    silver = fx.silver(spark, sf)
    answers = questions.ask_batch(
        fx.requests(spark, sf),
        fx.entries(spark, sf),
        _embedded(spark, sf),
        silver,
        views.route_risk(silver),
        fx.AS_OF,
    )
    return answers.drop("docs_block", "sources").withColumns(
        {
            "tools_used": F.array_join("tools_used", ","),
            "history_turns": F.col("history_turns").cast("bigint"),
        }
    )


@query("question_references")
def question_references(spark, sf):
    """References and citations of the batch; hashed vectors have no SQL twin."""
    asked = questions.accepted(fx.requests(spark, sf))
    matches = materialise(questions.matched_documents(asked, _embedded(spark, sf)), "matches")
    cited = req.citations(matches).withColumn(
        "sources", F.array_join(F.transform("sources", lambda c: c["doc_id"]), ",")
    )
    return req.reference_blocks(matches).join(cited, "request_id")
