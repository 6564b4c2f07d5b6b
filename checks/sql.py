"""SQL building blocks of the comparison queries: named subqueries and number formats."""

from __future__ import annotations

import re

from checks.fixtures import (
    ENTRIES,
    FLIGHTS,
    REDACTION,
    REQUESTS,
    RESPONSES,
    RUN_EVENTS,
    RUN_LOG,
    select_sql,
)
from flightlake.constants import AGENT_SIGNALS, OVERRIDE_PATTERNS

NOW = "TIMESTAMP '2024-01-31 06:00:00'"


def rnd(value: str, digits: int) -> str:
    """Round half up on the printed digits of a double, as Spark does."""
    return (
        f"CAST(round(CAST(CAST(({value}) AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"
    )


def pct(condition: str, digits: int = 1) -> str:
    share = f"CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) / nullif(count(*), 0)"
    return rnd(f"({share}) * CAST(100.0 AS DOUBLE)", digits)


def avg(value: str, digits: int) -> str:
    return rnd(f"avg(CAST({value} AS DOUBLE))", digits)


def short_number(value: str) -> str:
    return f"regexp_replace(CAST(CAST({value} AS DECIMAL(18,2)) AS VARCHAR), '\\.?0+$', '')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def redact(value: str) -> str:
    pattern = "(" + "|".join(OVERRIDE_PATTERNS) + ")"
    return f"regexp_replace({value}, {quoted(pattern)}, '[REDACTED]', 'gi')"


def signals(value: str) -> str:
    """Router words between word edges, spelled out because the engines differ on \\b."""
    pattern = (
        r"(?i)(^|[^\p{L}\p{N}_])(" + "|".join(AGENT_SIGNALS) + r")([^\p{L}\p{N}_]|$)"
    )
    return f"regexp_matches({value}, {quoted(pattern)})"


CTES: dict[str, str] = {
    "raw": select_sql(FLIGHTS, "events"),
    "raw_text": (
        "SELECT * REPLACE (strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_ts) "
        "FROM raw"
    ),
    "typed": """
        SELECT flight_id, airline, origin, destination,
          TRY_CAST(departure_delay_min AS INTEGER) AS departure_delay_min,
          TRY_CAST(arrival_delay_min AS INTEGER) AS arrival_delay_min,
          TRY_CAST(weather_flag AS BOOLEAN) AS weather_flag,
          status, event_ts, CAST(event_ts AS DATE) AS ingest_date
        FROM raw""",
    "keyed": """
        SELECT * FROM typed
        WHERE flight_id IS NOT NULL AND airline IS NOT NULL AND origin IS NOT NULL
          AND destination IS NOT NULL AND event_ts IS NOT NULL""",
    "ranged": """
        SELECT * FROM keyed
        WHERE departure_delay_min BETWEEN -60 AND 600 AND arrival_delay_min BETWEEN -60 AND 600""",
    "passing": "SELECT * FROM ranged WHERE origin <> destination",
    "silver": """
        SELECT * EXCLUDE (pick) FROM (
          SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY event_ts, airline, origin,
            destination, departure_delay_min, arrival_delay_min, status NULLS FIRST,
            weather_flag NULLS FIRST) AS pick
          FROM passing) ranked
        WHERE pick = 1""",
    "routed": "SELECT *, origin || '-' || destination AS route FROM silver",
    "by_airline": f"""
        SELECT 'by_airline' AS summary_type, airline AS dimension_key,
          {avg('departure_delay_min', 2)} AS avg_dep_delay_min,
          {avg('arrival_delay_min', 2)} AS avg_arr_delay_min, count(*) AS total_flights
        FROM silver GROUP BY airline""",
    "by_route": f"""
        SELECT 'by_route' AS summary_type, route AS dimension_key,
          {avg('departure_delay_min', 2)} AS avg_dep_delay_min,
          {avg('arrival_delay_min', 2)} AS avg_arr_delay_min, count(*) AS total_flights
        FROM routed GROUP BY route""",
    "by_day": """
        SELECT 'delayed_by_day' AS summary_type, CAST(ingest_date AS VARCHAR) AS dimension_key,
          CAST(NULL AS DOUBLE) AS avg_dep_delay_min, CAST(NULL AS DOUBLE) AS avg_arr_delay_min,
          count(*) AS total_flights,
          count(*) FILTER (WHERE weather_flag) AS weather_related
        FROM silver WHERE status = 'DELAYED' GROUP BY ingest_date""",
    "on_time": f"""
        SELECT 'on_time_pct' AS summary_type, airline AS dimension_key,
          CAST(NULL AS DOUBLE) AS avg_dep_delay_min, CAST(NULL AS DOUBLE) AS avg_arr_delay_min,
          count(*) AS total_flights,
          {rnd("CAST(count(*) FILTER (WHERE status = 'ON_TIME') AS DOUBLE) * CAST(100.0 AS DOUBLE)"
               " / count(*)", 2)} AS on_time_pct
        FROM silver GROUP BY airline""",
    "gold_rows": """
        SELECT * FROM by_airline UNION ALL SELECT * FROM by_route
        UNION ALL SELECT * EXCLUDE (weather_related) FROM by_day
        UNION ALL SELECT * EXCLUDE (on_time_pct) FROM on_time""",
    "gold": f"SELECT *, {NOW} AS generated_ts FROM gold_rows",
    "route_rates": """
        SELECT route, min(airline) AS dominant_airline, count(*) AS total_flights,
          CAST(count(*) FILTER (WHERE status IN ('DELAYED','CANCELLED','DIVERTED')) AS DOUBLE)
            / count(*) AS disruption_rate,
          CAST(count(*) FILTER (WHERE departure_delay_min >= 60 OR arrival_delay_min >= 60)
            AS DOUBLE) / count(*) AS severe_delay_rate,
          CAST(count(*) FILTER (WHERE weather_flag) AS DOUBLE) / count(*) AS weather_impact_rate,
          avg(departure_delay_min) AS avg_departure_delay_min,
          avg(arrival_delay_min) AS avg_arrival_delay_min
        FROM routed GROUP BY route""",
    "routes": f"""
        SELECT *, {rnd('''CAST(100.0 AS DOUBLE) * (CAST(0.45 AS DOUBLE) * disruption_rate
          + CAST(0.35 AS DOUBLE) * severe_delay_rate
          + CAST(0.20 AS DOUBLE) * weather_impact_rate)''', 2)} AS risk_score
        FROM route_rates""",
    "airlines": """
        SELECT dimension_key AS airline, avg_dep_delay_min, avg_arr_delay_min, total_flights,
          generated_ts
        FROM gold WHERE summary_type = 'by_airline'""",
    "daily": """
        SELECT CAST(dimension_key AS DATE) AS delay_date, total_flights AS delayed_flights,
          generated_ts
        FROM gold WHERE summary_type = 'delayed_by_day'""",
    "reasons": """
        SELECT *, CASE
          WHEN flight_id IS NULL OR flight_id = '' THEN 'missing required field: flight_id'
          WHEN airline IS NULL OR airline = '' THEN 'missing required field: airline'
          WHEN origin IS NULL OR origin = '' THEN 'missing required field: origin'
          WHEN destination IS NULL OR destination = ''
            THEN 'missing required field: destination'
          WHEN event_ts IS NULL OR event_ts = '' THEN 'missing required field: event_ts'
          WHEN departure_delay_min IS NULL OR departure_delay_min = ''
            THEN 'missing required field: departure_delay_min'
          WHEN arrival_delay_min IS NULL OR arrival_delay_min = ''
            THEN 'missing required field: arrival_delay_min'
          WHEN status IS NULL OR status = '' THEN 'missing required field: status'
          WHEN weather_flag IS NULL OR weather_flag = ''
            THEN 'missing required field: weather_flag'
          WHEN TRY_CAST(departure_delay_min AS INTEGER) IS NULL
            THEN 'invalid value: departure_delay_min'
          WHEN TRY_CAST(arrival_delay_min AS INTEGER) IS NULL
            THEN 'invalid value: arrival_delay_min'
          WHEN TRY_CAST(replace(event_ts, '+00:00', '') AS TIMESTAMP) IS NULL
            THEN 'invalid value: event_ts' END AS reject_reason
        FROM raw_text""",
    "doc_rows": """
        SELECT flight_id AS doc_id,
          'Flight ' || flight_id || ' for airline ' || airline || ' on route ' || origin || '-'
          || destination || ' had departure delay ' || departure_delay_min
          || ' minutes and arrival delay ' || arrival_delay_min || ' minutes. Status was '
          || status || '. Weather impact flag was '
          || CASE WHEN weather_flag = 'TRUE' THEN 'True' ELSE 'False' END
          || '. Event timestamp was ' || event_ts || '.' AS content,
          'flight_event' AS source_type, airline, origin || '-' || destination AS route,
          CAST(substring(event_ts, 1, 10) AS DATE) AS event_date,
          '{"status":"' || status || '","weather_flag":'
          || CASE WHEN weather_flag = 'TRUE' THEN 'true' ELSE 'false' END
          || ',"departure_delay_min":' || departure_delay_min
          || ',"arrival_delay_min":' || arrival_delay_min || '}' AS metadata,
          CAST(replace(event_ts, '+00:00', '') AS TIMESTAMP) AS updated_ts
        FROM reasons WHERE reject_reason IS NULL""",
    "docs": """
        SELECT * EXCLUDE (pick) FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id
            ORDER BY updated_ts DESC, content NULLS FIRST) AS pick
          FROM doc_rows) ranked
        WHERE pick = 1""",
    "doc_measures": """
        SELECT airline, route, event_date,
          TRY_CAST(json_extract_string(metadata, '$.departure_delay_min') AS DOUBLE) AS delay_min,
          lower(json_extract_string(metadata, '$.weather_flag')) = 'true' AS weather,
          json_extract_string(metadata, '$.status') AS status
        FROM docs""",
    "recent_docs": "SELECT * FROM doc_measures WHERE event_date >= DATE '2024-01-24'",
    "recent_flights": "SELECT * FROM routed WHERE ingest_date >= DATE '2024-01-24'",
    "batch": """
        SELECT doc_id, 'Revised: ' || content AS content, source_type, airline, route, event_date,
          metadata, updated_ts + INTERVAL 1 DAY AS updated_ts
        FROM docs WHERE json_extract_string(metadata, '$.status') = 'DELAYED'
        UNION ALL
        SELECT doc_id, 'Again: ' || content AS content, source_type, airline, route, event_date,
          metadata, updated_ts + INTERVAL 2 DAY AS updated_ts
        FROM docs WHERE json_extract_string(metadata, '$.weather_flag') = 'true'
        UNION ALL
        SELECT 'N-' || doc_id AS doc_id, content, source_type, airline, route, event_date,
          metadata, updated_ts + INTERVAL 1 DAY AS updated_ts
        FROM docs WHERE json_extract_string(metadata, '$.status') = 'CANCELLED'""",
    "merged": """
        SELECT * EXCLUDE (pick, stage) FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id
            ORDER BY stage DESC, updated_ts DESC, content) AS pick
          FROM (SELECT *, 0 AS stage FROM docs UNION ALL SELECT *, 1 AS stage FROM batch) both_)
        WHERE pick = 1""",
    "log": select_sql(RUN_LOG, "events"),
    "kept_log": "SELECT * FROM log WHERE CAST(log_ts AS DATE) >= DATE '2024-01-12'",
    "usage": """
        SELECT log_ts AS timestamp, date_trunc('hour', log_ts) AS hour, session_id, endpoint,
          CAST(prompt_tokens AS BIGINT) AS prompt_tokens,
          CAST(response_tokens AS BIGINT) AS response_tokens,
          CAST(total_tokens AS BIGINT) AS total_tokens
        FROM kept_log WHERE event = 'token_usage'""",
    "guardrails": """
        SELECT log_ts AS timestamp, date_trunc('hour', log_ts) AS hour, event AS event_type,
          guardrail_type, reason, session_id, CAST(vs_results AS BIGINT) AS vs_results, severity
        FROM kept_log WHERE event IN ('guardrail_triggered', 'bq_fallback')""",
    "requests": select_sql(REQUESTS, "conversations") + " WHERE role = 'user'",
    "clean_requests": """
        SELECT request_id, conv_id, trim(question, E' \\t\\n\\r\\f\\v') AS question,
          nullif(trim(session_id), '') AS session_id, nullif(trim(upper(airline)), '') AS airline,
          nullif(trim(upper(route)), '') AS route, days_back, top_k
        FROM requests""",
    "checked": """
        SELECT *, CASE
          WHEN question = '' THEN 'Missing ''question'' field'
          WHEN length(question) > 500 THEN '''question'' must be 500 characters or fewer'
          WHEN session_id IS NOT NULL
            AND NOT regexp_full_match(session_id, '[A-Za-z0-9_\\-]{1,64}')
            THEN '''session_id'' must contain only letters, digits, hyphens, or underscores (max 64 chars)'
          WHEN airline IS NOT NULL AND NOT regexp_full_match(airline, '[A-Z0-9]{2,3}')
            THEN '''airline'' must be a 2–3 character IATA code (e.g. ''AA'')'
          WHEN route IS NOT NULL AND NOT regexp_full_match(route, '[A-Z]{3}-[A-Z]{3}')
            THEN '''route'' must be ORIGIN-DEST with 3-letter codes (e.g. ''ATL-LAX'')'
          WHEN days_back NOT BETWEEN 1 AND 30 THEN '''days_back'' must be between 1 and 30'
          WHEN top_k NOT BETWEEN 1 AND 20 THEN '''top_k'' must be between 1 and 20'
          END AS error
        FROM clean_requests""",
    "asked": """
        SELECT *, CASE WHEN NOT (contains(lower(question), 'risk')
            OR contains(lower(question), 'disruption') OR contains(lower(question), 'delay'))
            THEN 'generic'
          WHEN contains(lower(question), 'route') THEN 'route_risk' ELSE 'airline' END AS query_type
        FROM checked WHERE error IS NULL""",
    "directed": f"""
        SELECT *, CASE WHEN length(question) - length(replace(question, '?', '')) > 1
            OR {signals('question')} THEN 'agent' ELSE 'retrieve' END AS routed_to
        FROM asked""",
    "asked_docs": """
        SELECT a.request_id, d.* FROM asked a JOIN doc_measures d
          ON d.event_date >= DATE '2024-01-31' - a.days_back
          AND (a.airline IS NULL OR a.airline = d.airline)
          AND (a.route IS NULL OR a.route = d.route)""",
    "asked_pairs": f"""
        SELECT request_id, airline, route, count(*) AS flight_count,
          {avg('delay_min', 1)} AS avg_delay_min, {pct('weather')} AS weather_impact_pct,
          {pct("status = 'DELAYED'")} AS delayed_pct
        FROM asked_docs GROUP BY request_id, airline, route""",
    "matches": """
        SELECT r.request_id, d.doc_id, d.text AS content, d.source AS source_type,
          '' AS airline, d.lang AS route, '' AS event_date,
          CAST(100 - 5 * (d.doc_id % 10) AS DOUBLE) / 100 AS distance,
          CAST(row_number() OVER (PARTITION BY r.request_id ORDER BY d.doc_id) AS INTEGER)
            AS match_rank
        FROM requests r
        JOIN documents d ON d.doc_id // 10 = r.conv_id
        JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 1""",
    "entries": select_sql(ENTRIES, "conversations") + " WHERE role IN ('user', 'assistant')",
    "timed": f"SELECT *, {NOW} - idle_s * INTERVAL 1 SECOND AS entry_ts FROM entries",
    "last_entries": """
        SELECT * EXCLUDE (pick) FROM (
          SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY entry_no DESC) AS pick
          FROM timed) ranked WHERE pick <= 4""",
    "all_entries": "SELECT * FROM timed",
    "redaction": select_sql(REDACTION, "documents"),
    "run_events": select_sql(RUN_EVENTS, "conversations"),
    "risk_pairs": f"""
        SELECT airline, route, {avg('delay_min', 1)} AS avg_delay_min, {pct('weather')} AS weather_pct
        FROM recent_docs GROUP BY airline, route""",
    "truth": """
        SELECT run_id, avg_delay_min, weather_pct FROM (
          SELECT r.run_id, p.avg_delay_min, p.weather_pct, row_number() OVER (PARTITION BY r.run_id
            ORDER BY p.avg_delay_min DESC, p.airline, p.route) AS pick
          FROM run_rows r JOIN risk_pairs p
            ON (r.airline IS NULL OR r.airline = '' OR upper(r.airline) = p.airline)
            AND (r.route IS NULL OR r.route = '' OR upper(r.route) = p.route)) ranked
        WHERE pick = 1""",
    "case_rows": """
        SELECT conv_id AS run_id,
          substring('AADLUAWNB6ASNKF9G4HAZZ', CAST(1 + 2 * (conv_id % 11) AS INT), 2) AS airline,
          CASE conv_id % 3 WHEN 0 THEN 'agent' WHEN 1 THEN 'multi_agent' ELSE 'coordinate' END
            AS architecture,
          concat('case ', CAST(conv_id % 20 AS VARCHAR(20))) AS question,
          CAST(sum(length(text)) AS BIGINT) * 10 AS total_tokens, count(*) AS tool_calls
        FROM conversations GROUP BY conv_id""",
    "run_rows": """
        SELECT c.* EXCLUDE (airline), CASE WHEN run_id % 7 >= 5 THEN NULL ELSE airline END AS airline,
          CASE run_id % 7 WHEN 0 THEN lower(last_route) WHEN 1 THEN 'QQQ-QQQ' WHEN 2 THEN ''
            WHEN 5 THEN last_route END AS route
        FROM case_rows c LEFT JOIN (
          SELECT airline, max(route) AS last_route FROM risk_pairs GROUP BY airline) l
        USING (airline)""",
    "runs": """
        SELECT r.*, CASE
          WHEN r.run_id % 3 = 0 THEN concat('Escalate to operations: average delay is ',
            CAST(CAST(t.avg_delay_min AS DECIMAL(18,1)) AS VARCHAR(20)), ' minutes.')
          WHEN r.run_id % 3 = 1 THEN concat('Monitor the weather, share ',
            CAST(CAST(t.weather_pct AS DECIMAL(18,1)) AS VARCHAR(20)), '%.')
          ELSE concat('Within normal variance, run ', CAST(r.run_id AS VARCHAR(20))) END AS answer
        FROM run_rows r LEFT JOIN truth t USING (run_id)""",
    "responses": select_sql(RESPONSES, "conversations"),
}


def sql(body: str) -> str:
    """The query with every named subquery it uses, in dependency order."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in needed) + "\n" + body
