"""The views and tools of a whole lakehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import flights  # noqa: F401  its SQL is used again here
from checks.facts import PAIR_ORDER, PAIRS, RAG_STATUS
from checks.registry import ORACLES, query
from checks.sessions import _kept
from checks.sql import sql
from flightlake.operators.vectors import embed_documents
from flightlake.plans.sql_tools import register_tools
from flightlake.plans.warehouse import Warehouse


def _warehouse(spark, sf) -> Warehouse:
    return Warehouse(
        spark,
        embed_documents(fx.document_table(spark, sf)),
        fx.AS_OF,
        fx.silver(spark, sf),
        fx.gold(spark, sf),
        _kept(spark, sf),
    )


VIEW_ROWS = {
    "ai_rag_documents": "docs",
    "silver_flights_ext": "silver",
    "ai_delay_explanations_v": "silver",
    "ai_route_risk_v": "routes",
    "gold_summary_ext": "gold",
    "bi_airline_performance_v": "airlines",
    "bi_route_performance_v": "by_route",
    "bi_daily_delays_v": "daily",
    "bi_pipeline_refresh_v": "(SELECT 1) one_row",
    "ai_nl_analytics_facts_v": "(SELECT route FROM routes UNION ALL SELECT airline FROM airlines)",
    "monitoring_token_usage_v": "usage",
    "monitoring_guardrails_v": "guardrails",
}


@query(
    "sql_views",
    sql(
        " UNION ALL ".join(
            f"SELECT '{view}' AS view_name, count(*) AS rows_found FROM {rows}"
            for view, rows in VIEW_ROWS.items()
        )
    ),
)
def sql_views(spark, sf):
    """Rows of every registered view, counted through SQL."""
    names = _warehouse(spark, sf).register()
    return spark.sql(
        " UNION ALL ".join(
            f"SELECT '{name}' AS view_name, count(*) AS rows_found FROM {name}" for name in names
        )
    )


@query(
    "sql_dashboard",
    sql(
        "SELECT a.airline, a.total_flights, count(*) FILTER (WHERE r.status = 'DELAYED') AS delayed "
        "FROM airlines a JOIN silver r ON r.airline = a.airline GROUP BY a.airline, a.total_flights"
    ),
)
def sql_dashboard(spark, sf):
    """A user's own SQL over two views."""
    _warehouse(spark, sf).register()
    return spark.sql(
        "SELECT a.airline, a.total_flights, count_if(d.status = 'DELAYED') AS delayed "
        "FROM bi_airline_performance_v a JOIN ai_delay_explanations_v d ON d.airline = a.airline "
        "GROUP BY a.airline, a.total_flights"
    )


@query("tool_delay_risk", sql(f"{PAIRS} WHERE airline = 'AA' {PAIR_ORDER} LIMIT 5"))
def tool_delay_risk(spark, sf):
    return _warehouse(spark, sf).detect_delay_risk("aa")


@query(
    "tool_health",
    sql(
        "SELECT max(generated_ts) AS last_generated_ts, count(*) AS gold_summary_rows, "
        "count(*) FILTER (WHERE summary_type = 'by_airline') AS airline_rows, "
        "count(*) FILTER (WHERE summary_type = 'by_route') AS route_rows, "
        "CAST(sum(total_flights) AS BIGINT) AS total_flights_across_summaries, "
        "'gold_layer' AS source FROM gold"
    ),
)
def tool_health(spark, sf):
    return _warehouse(spark, sf).check_health()


@query("tool_status_fallback", sql(f"SELECT *, 'ai_rag_documents' AS source FROM ({RAG_STATUS}) s"))
def tool_status_fallback(spark, sf):
    """Gold is not there yet."""
    lake = _warehouse(spark, sf)
    lake.gold = None
    return lake.get_status()


@query("tool_search")
def tool_search(spark, sf):
    return _warehouse(spark, sf).search_flight_records("weather delays on route ATL-LAX", 5)


# --- the tools as SQL table functions ---


def _asked(spark, sf, call: str, fields: str | None = None):
    """The rows of a call in SQL; a fact's JSON as columns beside its source where ``fields`` names them."""
    register_tools(_warehouse(spark, sf))
    rows = spark.sql(f"SELECT * FROM {call}")
    if fields is None:
        return rows
    return rows.select("source", F.from_json("fact", fields).alias("fact")).select("source", "fact.*")


AIRLINE_FIELDS = (
    "airline string, flight_count bigint, avg_delay_min double, delayed_pct double, weather_pct double"
)
WEATHER_FIELDS = (
    "total_flights bigint, weather_affected bigint, weather_pct double, avg_delay_if_weather double"
)


@query("sql_delay_risk", ORACLES["tool_delay_risk"])
def sql_delay_risk(spark, sf):
    return _asked(spark, sf, "detect_delay_risk('aa')")


@query("sql_weather_impact", ORACLES["weather_impact"])
def sql_weather_impact(spark, sf):
    return _asked(spark, sf, "detect_weather_impact(airline => 'dl')")


@query("tool_weather_impact", ORACLES["weather_impact"])
def tool_weather_impact(spark, sf):
    return _warehouse(spark, sf).detect_weather_impact("dl")


@query("sql_pipeline_status", f"SELECT *, 'gold_layer' AS source FROM ({ORACLES['gold_refresh']}) g")
def sql_pipeline_status(spark, sf):
    return _asked(spark, sf, "get_pipeline_status()")


@query("sql_facts_fallback", f"SELECT *, 'secondary' AS source FROM ({ORACLES['weather_facts']}) w")
def sql_facts_fallback(spark, sf):
    """No document is of that airline; the weather report knows no airline."""
    return _asked(spark, sf, "query_facts('weather', airline => 'ZZ')", WEATHER_FIELDS)


@query("tool_facts_fallback", ORACLES["sql_facts_fallback"])
def tool_facts_fallback(spark, sf):
    return _warehouse(spark, sf).query_facts("weather", airline="ZZ")


@query("sql_analytics", ORACLES["query_analytics"])
def sql_analytics(spark, sf):
    return _asked(spark, sf, "query_analytics('airline', 'aa')", AIRLINE_FIELDS)


@query("sql_analytics_fallback", ORACLES["query_analytics_fallback"])
def sql_analytics_fallback(spark, sf):
    """No flight has that airline's route report yet, so the documents answer."""
    lake = _warehouse(spark, sf)
    lake.silver = lake.silver.where("airline = 'none'")
    register_tools(lake)
    rows = spark.sql("SELECT * FROM query_analytics('airline')")
    pairs = "airline string, route string, flight_count bigint, avg_delay_min double, weather_pct double, delayed_pct double"
    return rows.select("source", F.from_json("fact", pairs).alias("fact")).select("source", "fact.*")
