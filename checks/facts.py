"""Parameterised facts, status reports and batch facts."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.flights import ROUTE_FACTS
from checks.registry import query
from checks.sql import avg, pct, rnd, sql
from flightlake.functions.measures import clamp
from flightlake.operators import batch_facts as batch
from flightlake.operators import day_bitmaps, facts, views
from flightlake.operators.gold import with_route
from flightlake.operators.requests import facts_query_type, validate_requests
from flightlake.session import materialise

PAIRS = f"""
  SELECT airline, route, count(*) AS flight_count, {avg('delay_min', 1)} AS avg_delay_min,
    {pct('weather')} AS weather_pct, {pct("status = 'DELAYED'")} AS delayed_pct
  FROM recent_docs"""
PAIR_ORDER = "GROUP BY airline, route ORDER BY avg_delay_min DESC, airline, route"

AIRLINE_FACTS = f"""
  SELECT airline, count(*) AS flight_count, {avg('departure_delay_min', 1)} AS avg_delay_min,
    {pct('departure_delay_min > 15')} AS delayed_pct, {pct('weather_flag')} AS weather_pct
  FROM recent_flights"""
AIRLINE_ORDER = "GROUP BY airline ORDER BY avg_delay_min DESC, airline LIMIT 10"


@query("days_back_filter", sql("SELECT * EXCLUDE (route) FROM recent_flights"))
def days_back_filter(spark, sf):
    return facts.days_back_filter(fx.silver(spark, sf), "ingest_date", fx.AS_OF, fx.DAYS)


@query(
    "optional_filters",
    sql(
        "SELECT * FROM recent_flights WHERE airline = 'AA' "
        "UNION ALL SELECT * FROM recent_flights WHERE route = 'ATL-LAX' "
        "UNION ALL SELECT * FROM recent_flights WHERE airline = 'DL' AND route = 'ATL-LAX' "
        "UNION ALL SELECT * FROM recent_flights"
    ),
)
def optional_filters(spark, sf):
    flights = with_route(facts.recent_flights(fx.silver(spark, sf), fx.AS_OF, fx.DAYS))
    # stored once: a task of the union would else rank its flights four times over, all at once in memory
    recent = materialise(flights, "recent")
    return (
        facts.optional_filters(recent, "AA")
        .unionByName(facts.optional_filters(recent, route="ATL-LAX"))
        .unionByName(facts.optional_filters(recent, "DL", "ATL-LAX"))
        .unionByName(facts.optional_filters(recent, "", None))
    )


@query(
    "days_back_rules",
    sql(
        "SELECT request_id, CASE WHEN days_back < 1 THEN 7 ELSE days_back END AS service_days, "
        "greatest(1, least(days_back, 30)) AS tool_days FROM requests"
    ),
)
def days_back_rules(spark, sf):
    days = F.col("days_back")
    return fx.requests(spark, sf).select(
        "request_id",
        F.when(days < 1, facts.service_days_back(0)).otherwise(days).alias("service_days"),
        clamp(days, 1, 30).alias("tool_days"),
    )


@query("rag_facts", sql(f"{PAIRS} {PAIR_ORDER} LIMIT 10"))
def rag_facts(spark, sf):
    return facts.rag_facts(fx.document_table(spark, sf), fx.AS_OF, fx.DAYS)


@query("rag_facts_airline", sql(f"{PAIRS} WHERE airline = 'UA' {PAIR_ORDER} LIMIT 10"))
def rag_facts_airline(spark, sf):
    return facts.rag_facts(fx.document_table(spark, sf), fx.AS_OF, fx.DAYS, airline="UA")


@query("rag_facts_route", sql(f"{PAIRS} WHERE route = 'ATL-LAX' {PAIR_ORDER} LIMIT 10"))
def rag_facts_route(spark, sf):
    return facts.rag_facts(fx.document_table(spark, sf), fx.AS_OF, fx.DAYS, route="ATL-LAX")


@query(
    "top10_by_delay",
    sql(f"SELECT airline, route, avg_delay_min FROM ({PAIRS} {PAIR_ORDER} LIMIT 10) top"),
)
def top10_by_delay(spark, sf):
    top = facts.rag_facts(fx.document_table(spark, sf), fx.AS_OF, fx.DAYS)
    return top.select("airline", "route", "avg_delay_min")


@query("delay_risk", sql(f"{PAIRS} WHERE airline = 'DL' {PAIR_ORDER} LIMIT 5"))
def delay_risk(spark, sf):
    return facts.delay_risk(fx.document_table(spark, sf), fx.AS_OF, airline="dl")


@query("top5_delay_risk", sql(f"{PAIRS} {PAIR_ORDER} LIMIT 5"))
def top5_delay_risk(spark, sf):
    return facts.delay_risk(fx.document_table(spark, sf), fx.AS_OF)


@query("route_risk_facts", sql(f"{ROUTE_FACTS} WHERE route = 'ATL-LAX'"))
def route_risk_facts(spark, sf):
    return facts.route_risk_facts(views.route_risk(fx.silver(spark, sf)), "ATL-LAX")


@query(
    "route_risk_facts_agent",
    sql(
        f"SELECT * EXCLUDE (severe_delay_pct) FROM ({ROUTE_FACTS}) r "
        "ORDER BY avg_risk_score DESC, route LIMIT 10"
    ),
)
def route_risk_facts_agent(spark, sf):
    return facts.route_risk_facts(views.route_risk(fx.silver(spark, sf)), severe=False)


@query(
    "top10_by_risk",
    sql(
        f"SELECT route, avg_risk_score FROM ({ROUTE_FACTS}) r "
        "ORDER BY avg_risk_score DESC, route LIMIT 10"
    ),
)
def top10_by_risk(spark, sf):
    top = facts.route_risk_facts(views.route_risk(fx.silver(spark, sf)))
    return top.select("route", "avg_risk_score")


@query("airline_facts", sql(f"{AIRLINE_FACTS} {AIRLINE_ORDER}"))
def airline_facts(spark, sf):
    return facts.airline_facts(fx.silver(spark, sf), fx.AS_OF, fx.DAYS)


WEATHER_FACTS = f"""
  SELECT count(*) AS total_flights, count(*) FILTER (WHERE weather_flag) AS weather_affected,
    {pct('weather_flag')} AS weather_pct,
    {rnd("avg(CAST(departure_delay_min AS DOUBLE)) FILTER (WHERE weather_flag)", 1)}
      AS avg_delay_if_weather
  FROM recent_flights"""


@query("weather_facts", sql(WEATHER_FACTS))
def weather_facts(spark, sf):
    return facts.weather_facts(fx.silver(spark, sf), fx.AS_OF, fx.DAYS)


@query("weather_facts_empty", sql(f"{WEATHER_FACTS} WHERE ingest_date > DATE '2030-01-01'"))
def weather_facts_empty(spark, sf):
    """No flight in the window: counts are zero and ratios NULL, not an error."""
    import datetime as dt

    return facts.weather_facts(fx.silver(spark, sf), dt.date(2031, 1, 1), fx.DAYS)


@query(
    "weather_impact",
    sql(
        f"""
        SELECT count(*) AS total_flights, count(*) FILTER (WHERE weather) AS weather_affected,
          {pct('weather')} AS weather_pct,
          {rnd("avg(delay_min) FILTER (WHERE weather)", 1)} AS avg_delay_if_weather,
          {rnd("avg(delay_min) FILTER (WHERE NOT weather)", 1)} AS avg_delay_if_not_weather
        FROM recent_docs WHERE airline = 'DL'"""
    ),
)
def weather_impact(spark, sf):
    return facts.weather_impact(fx.document_table(spark, sf), fx.AS_OF, "DL")


@query(
    "generic_facts",
    sql(
        "SELECT count(*) AS total_flights, count(DISTINCT airline) AS airline_count, "
        f"count(DISTINCT route) AS route_count, {avg('departure_delay_min', 1)} "
        "AS avg_delay_minutes FROM recent_flights"
    ),
)
def generic_facts(spark, sf):
    return facts.generic_facts(fx.silver(spark, sf), fx.AS_OF, fx.DAYS)


WINDOWS = [1, 7, 30]


@query(
    "window_totals",
    sql(
        " UNION ALL ".join(
            f"SELECT {days} AS days_back, count(*) AS total_flights, "
            "count(DISTINCT airline) AS airline_count, count(DISTINCT route) AS route_count, "
            f"{avg('departure_delay_min', 1)} AS avg_delay_minutes "
            f"FROM routed WHERE ingest_date >= DATE '2024-01-31' - {days}"
            for days in WINDOWS
        )
    ),
)
def window_totals(spark, sf):
    """Three windows from stored days; the second half of the days brings names of its own."""
    silver = fx.silver(spark, sf)
    later = F.col("ingest_date") >= "2024-01-16"
    early, late = silver.where(~later), silver.where(later)
    first = day_bitmaps.number_names(early)
    names = day_bitmaps.number_names(late, first)
    bitmaps = materialise(
        day_bitmaps.day_bitmaps(early, first).unionByName(day_bitmaps.day_bitmaps(late, names)), "bitmaps"
    )
    sums = materialise(day_bitmaps.day_sums(silver), "sums")
    return reduce(
        DataFrame.unionByName,
        [
            day_bitmaps.window_totals(sums, bitmaps, fx.AS_OF, days).withColumn("days_back", F.lit(days))
            for days in WINDOWS
        ],
    )


RAG_STATUS = """SELECT max(event_date) AS last_ingest_date, min(event_date) AS earliest_ingest_date,
  count(*) AS rag_document_count, count(DISTINCT airline) AS airline_count FROM docs"""


@query("rag_status", sql(RAG_STATUS))
def rag_status(spark, sf):
    return facts.rag_status(fx.document_table(spark, sf))


@query(
    "rag_freshness",
    sql(
        "SELECT count(*) AS total_docs, count(*) AS docs_with_embeddings, "
        "count(*) FILTER (WHERE updated_ts >= TIMESTAMP '2024-01-30 06:00:00') AS fresh_docs_24h "
        "FROM docs"
    ),
)
def rag_freshness(spark, sf):
    docs = fx.document_table(spark, sf).withColumn("embedding", F.array(F.lit(1.0)))
    return facts.rag_freshness(docs, fx.NOW)


@query(
    "facts_documents_first",
    sql(
        "SELECT * RENAME (weather_pct AS weather_impact_pct), 'ai_rag_documents' AS source "
        f"FROM ({PAIRS} {PAIR_ORDER} LIMIT 10) f"
    ),
)
def facts_documents_first(spark, sf):
    silver = fx.silver(spark, sf)
    return facts.service_facts(
        "airline", fx.document_table(spark, sf), silver, views.route_risk(silver), fx.AS_OF
    )


@query(
    "facts_with_fallback",
    sql(
        "SELECT * RENAME (weather_pct AS weather_impact_pct, avg_delay_min AS avg_delay_minutes), "
        f"'secondary' AS source FROM ({AIRLINE_FACTS} {AIRLINE_ORDER}) f"
    ),
)
def facts_with_fallback(spark, sf):
    """No document fits the filter, so the report for the query type answers."""
    silver = fx.silver(spark, sf)
    return facts.service_facts(
        "delays",
        fx.document_table(spark, sf).where("source_type = 'none'"),
        silver,
        views.route_risk(silver),
        fx.AS_OF,
        days_back=0,
    )


@query(
    "query_analytics",
    sql(
        f"SELECT *, 'primary' AS source FROM ({AIRLINE_FACTS} WHERE airline = 'AA' {AIRLINE_ORDER}) f"
    ),
)
def query_analytics(spark, sf):
    silver = fx.silver(spark, sf)
    return facts.query_analytics(
        "airline", fx.document_table(spark, sf), silver, views.route_risk(silver), fx.AS_OF, "aa"
    )


@query(
    "query_analytics_fallback",
    sql(f"SELECT *, 'ai_rag_documents' AS source FROM ({PAIRS} {PAIR_ORDER} LIMIT 10) f"),
)
def query_analytics_fallback(spark, sf):
    """Silver is not exported yet, so the documents answer."""
    return facts.query_analytics("airline", fx.document_table(spark, sf), None, None, fx.AS_OF)


@query(
    "freshness_status",
    sql(
        """
        SELECT max(generated_ts) AS last_generated_ts, count(*) AS gold_summary_rows,
          count(*) FILTER (WHERE summary_type = 'by_airline') AS airline_rows,
          count(*) FILTER (WHERE summary_type = 'by_route') AS route_rows,
          count(*) FILTER (WHERE summary_type = 'delayed_by_day') AS delayed_day_rows,
          count(*) FILTER (WHERE summary_type = 'on_time_pct') AS on_time_rows,
          CAST(sum(total_flights) AS BIGINT) AS total_flights_across_summaries,
          'gold_layer' AS source
        FROM gold"""
    ),
)
def freshness_status(spark, sf):
    return facts.freshness_status(fx.gold(spark, sf), fx.document_table(spark, sf))


@query("freshness_status_fallback", sql(f"SELECT *, 'ai_rag_documents' AS source FROM ({RAG_STATUS}) s"))
def freshness_status_fallback(spark, sf):
    empty = fx.gold(spark, sf).where("summary_type = 'none'")
    return facts.freshness_status(empty, fx.document_table(spark, sf))


@query(
    "mitigation_decision",
    sql(
        f"""
        SELECT *, CASE WHEN weather_pct >= 30 THEN 'monitor_weather'
          WHEN avg_delay_min > 60 THEN 'escalate_ops' ELSE 'no_action' END AS decision
        FROM ({PAIRS} {PAIR_ORDER} LIMIT 10) top"""
    ),
)
def mitigation_decision(spark, sf):
    return facts.mitigation_decision(facts.rag_facts(fx.document_table(spark, sf), fx.AS_OF))


def _asked(spark, sf):
    valid = validate_requests(fx.requests(spark, sf)).where("error IS NULL")
    return facts_query_type(valid)


@query(
    "batch_rag_facts",
    sql(
        """SELECT * FROM (
          SELECT *, CAST(row_number() OVER (PARTITION BY request_id
            ORDER BY avg_delay_min DESC, airline, route) AS INTEGER) AS fact_rank
          FROM asked_pairs) ranked WHERE fact_rank <= 10"""
    ),
)
def batch_rag_facts(spark, sf):
    asked = batch.with_setting(_asked(spark, sf)).select("request_id", *batch.SETTING)
    settings = asked.select(*batch.SETTING).distinct()
    found = batch.setting_rag_facts(settings, fx.document_table(spark, sf), fx.AS_OF)
    return batch._by_setting(asked, found, "inner").drop(*batch.SETTING)


def _parsed(rows):
    """Batch facts by their parsed fields: every field of every report, under five names."""

    def field(*names):
        return F.coalesce(*[F.get_json_object("fact_json", f"$.{name}") for name in names])

    def number(*names):
        return F.round(field(*names).cast("double"), 2)

    return rows.select(
        "request_id",
        "fact_rank",
        "source",
        F.concat_ws(" ", field("airline"), field("route")).alias("fact_key"),
        field("flight_count", "total_flights").cast("bigint").alias("flights"),
        number("avg_delay_min", "avg_delay_minutes", "avg_risk_score", "avg_delay_if_weather").alias(
            "measure"
        ),
        number("delayed_pct", "disruption_pct", "route_count", "weather_affected").alias(
            "second_measure"
        ),
        number("weather_impact_pct", "weather_pct").alias("weather_measure"),
        number("severe_delay_pct", "airline_count").alias("other_measure"),
    )


def _pairs_sql(asked_docs: str) -> str:
    """Ten slowest pairs per request of (request_id, document columns) rows."""
    return f"""SELECT request_id, CAST(pick AS INTEGER) AS fact_rank, 'ai_rag_documents' AS source,
          airline || ' ' || route AS fact_key, flight_count AS flights,
          {rnd('avg_delay_min', 2)} AS measure, {rnd('delayed_pct', 2)} AS second_measure,
          {rnd('weather_impact_pct', 2)} AS weather_measure, CAST(NULL AS DOUBLE) AS other_measure
        FROM (SELECT *, row_number() OVER (PARTITION BY request_id
                ORDER BY avg_delay_min DESC, airline, route) AS pick
          FROM (SELECT request_id, airline, route, count(*) AS flight_count,
              {avg('delay_min', 1)} AS avg_delay_min, {pct('weather')} AS weather_impact_pct,
              {pct("status = 'DELAYED'")} AS delayed_pct
            FROM ({asked_docs}) GROUP BY request_id, airline, route) pairs) ranked
        WHERE pick <= 10"""


@query("batch_facts", sql(_pairs_sql("SELECT * FROM asked_docs")))
def batch_facts(spark, sf):
    """At this scale every filter setting has documents, so they answer every question."""
    silver = fx.silver(spark, sf)
    return _parsed(
        batch.batch_facts(
            _asked(spark, sf),
            fx.document_table(spark, sf),
            silver,
            views.route_risk(silver),
            fx.AS_OF,
        )
    )


LATER = dt.date(2024, 2, 25)
LONG_WINDOW = "CASE request_id % 3 WHEN 0 THEN 45 WHEN 1 THEN 60 ELSE 30 END"


@query(
    "batch_facts_long_window",
    sql(
        _pairs_sql(
            f"""SELECT a.request_id, d.* FROM asked a JOIN doc_measures d
              ON d.event_date >= DATE '2024-02-25' - {LONG_WINDOW}
              AND (a.airline IS NULL OR a.airline = d.airline)
              AND (a.route IS NULL OR a.route = d.route)"""
        )
    ),
)
def batch_facts_long_window(spark, sf):
    """Windows of 30, 45 and 60 days; what the documents don't reach is left to the reports."""
    silver = fx.silver(spark, sf)
    asked = _asked(spark, sf).withColumn("days_back", F.expr(LONG_WINDOW))
    found = batch.batch_facts(
        asked, fx.document_table(spark, sf), silver, views.route_risk(silver), LATER
    )
    return _parsed(found).where("source = 'ai_rag_documents'")


def _reports_sql(asked: str) -> str:
    """Every request's own report, from rows (request_id, airline, route, days_back, report)."""
    recent = "JOIN silver s ON s.ingest_date >= DATE '2024-01-31' - a.days_back"
    return f"""
        SELECT request_id, CAST(pick AS INTEGER) AS fact_rank, 'secondary' AS source, fact_key,
          CAST(flights AS BIGINT) AS flights, {rnd('measure', 2)} AS measure,
          {rnd('second_measure', 2)} AS second_measure,
          {rnd('weather_measure', 2)} AS weather_measure, {rnd('other_measure', 2)} AS other_measure
        FROM (
          SELECT *, row_number() OVER (PARTITION BY request_id
            ORDER BY measure DESC, fact_key) AS pick
          FROM (
            SELECT a.request_id, s.airline AS fact_key, count(*) AS flights,
              {avg('s.departure_delay_min', 1)} AS measure,
              {pct('s.departure_delay_min > 15')} AS second_measure,
              {pct('s.weather_flag')} AS weather_measure, CAST(NULL AS DOUBLE) AS other_measure
            FROM ({asked}) a {recent} AND (a.airline IS NULL OR a.airline = s.airline)
            WHERE a.report = 'airline' GROUP BY a.request_id, s.airline
            UNION ALL
            SELECT a.request_id, '' AS fact_key, count(*) AS flights,
              {avg('s.departure_delay_min', 1)} AS measure,
              CAST(count(DISTINCT s.origin || '-' || s.destination) AS DOUBLE) AS second_measure,
              CAST(NULL AS DOUBLE) AS weather_measure,
              CAST(count(DISTINCT s.airline) AS DOUBLE) AS other_measure
            FROM ({asked}) a {recent} WHERE a.report = 'generic' GROUP BY a.request_id
            UNION ALL
            SELECT a.request_id, '' AS fact_key, count(*) AS flights,
              {avg('CASE WHEN s.weather_flag THEN s.departure_delay_min END', 1)} AS measure,
              CAST(count(*) FILTER (WHERE s.weather_flag) AS DOUBLE) AS second_measure,
              {pct('s.weather_flag')} AS weather_measure, CAST(NULL AS DOUBLE) AS other_measure
            FROM ({asked}) a {recent} WHERE a.report = 'weather' GROUP BY a.request_id
            UNION ALL
            SELECT a.request_id, f.route AS fact_key, f.flight_count AS flights,
              f.avg_risk_score AS measure, f.disruption_pct AS second_measure,
              f.weather_impact_pct AS weather_measure, f.severe_delay_pct AS other_measure
            FROM ({asked}) a JOIN ({ROUTE_FACTS}) f ON a.route IS NULL OR a.route = f.route
            WHERE a.report = 'risk') found) ranked
        WHERE pick <= 10"""


@query(
    "batch_facts_fallback",
    sql(
        _reports_sql(
            "SELECT *, CASE query_type WHEN 'route_risk' THEN 'risk' ELSE query_type END AS report FROM asked"
        )
    ),
)
def batch_facts_fallback(spark, sf):
    """No document is there yet, so every question gets the report it asks for."""
    silver = fx.silver(spark, sf)
    none = fx.document_table(spark, sf).where("source_type = 'none'")
    return _parsed(
        batch.batch_facts(_asked(spark, sf), none, silver, views.route_risk(silver), fx.AS_OF)
    )


QUERY_TYPE = """CASE request_id % 10 WHEN 0 THEN 'risk' WHEN 1 THEN 'disruption' WHEN 2 THEN 'route_risk'
  WHEN 3 THEN 'performance' WHEN 4 THEN 'delays' WHEN 5 THEN 'Airline' WHEN 6 THEN 'weather'
  WHEN 7 THEN 'IMPACT' WHEN 8 THEN 'generic' END"""


@query(
    "batch_facts_types",
    sql(
        _reports_sql(
            """SELECT *, CASE WHEN request_id % 10 < 3 THEN 'risk' WHEN request_id % 10 < 6 THEN 'airline'
              WHEN request_id % 10 < 8 THEN 'weather' ELSE 'generic' END AS report FROM asked"""
        )
    ),
)
def batch_facts_types(spark, sf):
    """All nine types, and none, without a document."""
    silver = fx.silver(spark, sf)
    none = fx.document_table(spark, sf).where("source_type = 'none'")
    asked = _asked(spark, sf).withColumn("query_type", F.expr(QUERY_TYPE))
    return _parsed(batch.batch_facts(asked, none, silver, views.route_risk(silver), fx.AS_OF))


AGENT_ASKED = f"""SELECT *, CASE WHEN query_type IN ('route_risk', 'risk') THEN 'risk'
    WHEN query_type IN ('airline', 'performance', 'delays') THEN 'airline'
    WHEN query_type = 'weather' THEN 'weather' ELSE 'documents' END AS report
  FROM (SELECT * REPLACE ({QUERY_TYPE} AS query_type) FROM asked) typed"""
NO_FLIGHTS = f"""SELECT request_id, CAST(1 AS INTEGER) AS fact_rank, 'secondary' AS source, '' AS fact_key,
    CAST(0 AS BIGINT) AS flights, CAST(NULL AS DOUBLE) AS measure, CAST(0 AS DOUBLE) AS second_measure,
    CAST(NULL AS DOUBLE) AS weather_measure, CAST(NULL AS DOUBLE) AS other_measure
  FROM ({AGENT_ASKED}) a WHERE report = 'weather'"""


def _agent_sql(reports: str) -> str:
    """The report's rows, else the documents'; the agent's risk report has no severe share."""
    return f"""
        SELECT * REPLACE ('primary' AS source, CAST(NULL AS DOUBLE) AS other_measure) FROM ({reports}) r
        UNION ALL
        SELECT p.* REPLACE (CASE WHEN a.report = 'documents' THEN 'primary' ELSE p.source END AS source)
        FROM ({_pairs_sql('SELECT * FROM asked_docs')}) p JOIN ({AGENT_ASKED}) a USING (request_id)
        WHERE request_id NOT IN (SELECT request_id FROM ({reports}) r)"""


@query("agent_batch_facts", sql(_agent_sql(_reports_sql(AGENT_ASKED))))
def agent_batch_facts(spark, sf):
    """All nine types, and none, by the agent's order; other spellings ask the documents."""
    silver = fx.silver(spark, sf)
    asked = _asked(spark, sf).withColumn("query_type", F.expr(QUERY_TYPE))
    return _parsed(
        batch.agent_batch_facts(
            asked, fx.document_table(spark, sf), silver, views.route_risk(silver), fx.AS_OF
        )
    )


@query("agent_batch_facts_fallback", sql(_agent_sql(NO_FLIGHTS)))
def agent_batch_facts_fallback(spark, sf):
    """Silver holds no flight yet: the documents answer all but the weather report."""
    silver = fx.silver(spark, sf).where("airline = 'none'")
    asked = _asked(spark, sf).withColumn("query_type", F.expr(QUERY_TYPE))
    return _parsed(
        batch.agent_batch_facts(
            asked, fx.document_table(spark, sf), silver, views.route_risk(silver), fx.AS_OF
        )
    )
