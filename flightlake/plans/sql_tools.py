"""The callable tools as SQL table functions, for users who write ``spark.sql`` only."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flightlake.constants import (
    AGENT_RISK_TYPES,
    AGENT_WEATHER_TYPES,
    AIRLINE_TYPES,
    DEFAULT_DAYS_BACK,
    LATE_DEPARTURE_MIN,
    MAX_DAYS_BACK,
    RISK_TYPES,
    SOURCE_DOCUMENTS,
    SOURCE_GOLD,
    WEATHER_TYPES,
)
from flightlake.operators.facts import document_measures
from flightlake.plans.warehouse import Warehouse
from flightlake.schemas import SILVER

AIRLINE = "airline STRING DEFAULT ''"
ROUTE = "route STRING DEFAULT ''"
DAYS = f"days_back INT DEFAULT {DEFAULT_DAYS_BACK}"
PAIR_COLUMNS = "airline STRING, route STRING, flight_count BIGINT, avg_delay_min DOUBLE, weather_pct DOUBLE, delayed_pct DOUBLE"
FACT = "source STRING, fact_rank INT, fact STRING"


def _percent(condition: str) -> str:
    return f"round(try_divide(CAST(count_if({condition}) AS DOUBLE), count(1)) * 100.0, 1)"


def _words(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _pairs(fn: str, clamped: str, as_of: str, rows: int) -> str:
    """The slowest airline-route pairs among the documents that the arguments of ``fn`` leave."""
    return f"""
    SELECT airline, route, count(1) AS flight_count, round(avg(delay_min), 1) AS avg_delay_min,
      {_percent("weather_text = 'true'")} AS weather_pct, {_percent("status = 'DELAYED'")} AS delayed_pct
    FROM tool_documents d
    WHERE event_date >= date_sub({as_of}, {clamped})
      AND (coalesce({fn}.airline, '') = '' OR d.airline = upper({fn}.airline))
      AND (coalesce({fn}.route, '') = '' OR d.route = upper({fn}.route))
    GROUP BY airline, route ORDER BY avg_delay_min DESC, airline, route LIMIT {rows}"""


def _as_facts(rows: str, source: str, columns: list[str], order: str) -> str:
    """Rows of a report as (source, fact_rank, fact): JSON with every field."""
    fields = ", ".join(f"'{c}', {c}" for c in columns)
    return f"""
    SELECT '{source}' AS source, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS fact_rank,
      to_json(named_struct({fields}), map('ignoreNullFields', 'false')) AS fact FROM ({rows})"""


def tool_functions(lake: Warehouse) -> dict[str, str]:
    """Name to ``CREATE FUNCTION`` of every tool whose tables exist."""
    as_of = f"DATE '{lake.as_of}'"

    def clamped(fn: str) -> str:
        return f"greatest(1, least({fn}.days_back, {MAX_DAYS_BACK}))"

    def created(name: str, arguments: str, columns: str, body: str) -> str:
        return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS TABLE ({columns}) RETURN {body}"

    risk, impact = "detect_delay_risk", "detect_weather_impact"
    found = {
        risk: created(risk, f"{AIRLINE}, {ROUTE}, {DAYS}", PAIR_COLUMNS, _pairs(risk, clamped(risk), as_of, 5)),
        impact: created(
            impact,
            f"{AIRLINE}, {DAYS}",
            "total_flights BIGINT, weather_affected BIGINT, weather_pct DOUBLE, "
            "avg_delay_if_weather DOUBLE, avg_delay_if_not_weather DOUBLE",
            f"""
    SELECT count(1), count_if(weather_text = 'true'), {_percent("weather_text = 'true'")},
      round(avg(CASE WHEN weather_text = 'true' THEN delay_min END), 1),
      round(avg(CASE WHEN weather_text <> 'true' THEN delay_min END), 1)
    FROM tool_documents d WHERE event_date >= date_sub({as_of}, {clamped(impact)})
      AND (coalesce({impact}.airline, '') = '' OR d.airline = upper({impact}.airline))""",
        ),
    }
    if lake.gold is not None:
        found["get_pipeline_status"] = created(
            "get_pipeline_status",
            "",
            "last_generated_ts TIMESTAMP, gold_summary_rows BIGINT, airline_rows BIGINT, route_rows BIGINT, "
            "delayed_day_rows BIGINT, on_time_rows BIGINT, total_flights_across_summaries BIGINT, source STRING",
            f"""
    SELECT last_generated_ts, gold_summary_rows, airline_rows, route_rows, delayed_day_rows, on_time_rows,
      total_flights_across_summaries, '{SOURCE_GOLD}' FROM bi_pipeline_refresh_v""",
        )
    if lake.silver is not None:
        for name, service in (("query_analytics", False), ("query_facts", True)):
            days = (
                f"CASE WHEN {name}.days_back < 1 THEN {DEFAULT_DAYS_BACK} ELSE {name}.days_back END"
                if service
                else clamped(name)
            )
            found[name] = created(
                name, f"query_type STRING, {AIRLINE}, {ROUTE}, {DAYS}", FACT, _facts(name, days, as_of, service)
            )
    return found


def _facts(fn: str, days: str, as_of: str, service: bool) -> str:
    """Every report with its condition; documents answer first for the service, last for the agent.

    The names and the rounding are those of the Python tools. Each branch is empty
    unless its type is asked for, and documents are only looked at when they are to
    answer.
    """
    rate = "round({0} * 100.0, 1) AS {1}"
    severe = [rate.format("severe_delay_rate", "severe_delay_pct")] if service else []
    risk_columns = ["route", "flight_count", "avg_risk_score", "disruption_pct", *(["severe_delay_pct"] if service else []), "weather_impact_pct"]
    risk = f"""
      SELECT route, total_flights AS flight_count, round(risk_score, 2) AS avg_risk_score,
        {", ".join([rate.format("disruption_rate", "disruption_pct"), *severe, rate.format("weather_impact_rate", "weather_impact_pct")])}
      FROM ai_route_risk_v r WHERE (coalesce({fn}.route, '') = '' OR r.route = upper({fn}.route))
      ORDER BY avg_risk_score DESC, route LIMIT 10"""
    flights = f"silver_flights_ext f WHERE ingest_date >= date_sub({as_of}, {days})"
    delay, weather = ("avg_delay_minutes", "weather_impact_pct") if service else ("avg_delay_min", "weather_pct")
    airline = f"""
      SELECT airline, count(1) AS flight_count, round(avg(CAST(departure_delay_min AS DOUBLE)), 1) AS {delay},
        {_percent(f"departure_delay_min > {LATE_DEPARTURE_MIN}")} AS delayed_pct, {_percent("weather_flag")} AS {weather}
      FROM {flights} AND (coalesce({fn}.airline, '') = '' OR f.airline = upper({fn}.airline))
      GROUP BY airline ORDER BY {delay} DESC, airline LIMIT 10"""
    impact = f"""
      SELECT count(1) AS total_flights, count_if(weather_flag) AS weather_affected, {_percent("weather_flag")} AS weather_pct,
        round(avg(CASE WHEN weather_flag THEN CAST(departure_delay_min AS DOUBLE) END), 1) AS avg_delay_if_weather
      FROM {flights}"""
    generic = f"""
      SELECT count(1) AS total_flights, count(DISTINCT airline) AS airline_count,
        count(DISTINCT concat(origin, '-', destination)) AS route_count,
        round(avg(CAST(departure_delay_min AS DOUBLE)), 1) AS avg_delay_minutes FROM {flights}"""
    pairs = _pairs(fn, days, as_of, 10)
    kind = f"lower({fn}.query_type)" if service else f"{fn}.query_type"
    risk_types = RISK_TYPES if service else AGENT_RISK_TYPES
    weather_types = WEATHER_TYPES if service else AGENT_WEATHER_TYPES
    known = _words([*risk_types, *AIRLINE_TYPES, *weather_types])
    first = "secondary" if service else "primary"
    reports = [
        (f"{kind} IN ({_words(risk_types)})", _as_facts(risk, first, risk_columns, "avg_risk_score DESC, route")),
        (
            f"{kind} IN ({_words(AIRLINE_TYPES)})",
            _as_facts(airline, first, ["airline", "flight_count", delay, "delayed_pct", weather], f"{delay} DESC, airline"),
        ),
        (
            f"{kind} IN ({_words(weather_types)})",
            _as_facts(impact, first, ["total_flights", "weather_affected", "weather_pct", "avg_delay_if_weather"], "1"),
        ),
    ]
    shown = ["airline", "route", "flight_count", "avg_delay_min", "weather_pct", "delayed_pct"]
    renamed = f"SELECT airline, route, flight_count, avg_delay_min, weather_pct AS weather_impact_pct, delayed_pct FROM ({pairs})"
    if service:
        reports.append(
            (f"{kind} NOT IN ({known})", _as_facts(generic, first, ["total_flights", "airline_count", "route_count", "avg_delay_minutes"], "1"))
        )
        names = [c.replace("weather_pct", "weather_impact_pct") for c in shown]
        documents = _as_facts(renamed, SOURCE_DOCUMENTS, names, "avg_delay_min DESC, airline, route")
        ranked = [(0, "true", documents), *((1, c, body) for c, body in reports)]
    else:
        order = "avg_delay_min DESC, airline, route"
        reports.append((f"{kind} NOT IN ({known})", _as_facts(pairs, first, shown, order)))
        ranked = [*((0, c, body) for c, body in reports), (1, f"{kind} IN ({known})", _as_facts(pairs, SOURCE_DOCUMENTS, shown, order))]
    branches = " UNION ALL ".join(f"SELECT {p} AS priority, * FROM ({body}) WHERE {c}" for p, c, body in ranked)
    return f"""
    SELECT source, fact_rank, fact FROM (SELECT *, min(priority) OVER () AS best FROM ({branches}))
    WHERE priority = best"""


def register_tools(lake: Warehouse) -> list[str]:
    """Make the views and the tools available to ``spark.sql``; returns the functions' names.

    ``SELECT * FROM detect_delay_risk(airline => 'AA', days_back => 14)``. Arguments are
    bound by Spark, never pasted into the text.
    """
    lake.register()
    if lake.silver is not None:
        _with_columns(lake.silver).createOrReplaceTempView("silver_flights_ext")
    document_measures(lake.documents).createOrReplaceTempView("tool_documents")
    functions = tool_functions(lake)
    for text in functions.values():
        lake.spark.sql(text)
    return sorted(functions)


def _with_columns(silver: DataFrame) -> DataFrame:
    return silver.select(*SILVER.fieldNames())
