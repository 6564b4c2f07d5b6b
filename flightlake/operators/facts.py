"""Parameterised facts over documents, Silver and the route-risk view.

Parameters reach the plan as literals, never as query text. Every function
takes the day it runs on; a report with a limit is a top-k plan with a second
sort key, so ties do not change from run to run.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.constants import (
    AGENT_RISK_TYPES,
    AGENT_WEATHER_TYPES,
    AIRLINE_TYPES,
    DECISION_ESCALATE,
    DECISION_NONE,
    DECISION_WEATHER,
    DEFAULT_DAYS_BACK,
    ESCALATION_DELAY_MIN,
    LATE_DEPARTURE_MIN,
    MAX_DAYS_BACK,
    RISK_TYPES,
    SOURCE_DOCUMENTS,
    SOURCE_GOLD,
    WEATHER_EVENT_PCT,
    WEATHER_TYPES,
)
from flightlake.functions.measures import mean, percent
from flightlake.functions.times import since
from flightlake.operators.views import gold_refresh
from flightlake.session import materialise

# the service shows some measures under other names and in another order than the tools
SERVICE_PAIR_ORDER = [
    "airline",
    "route",
    "flight_count",
    "avg_delay_min",
    "weather_impact_pct",
    "delayed_pct",
]
SERVICE_PAIR_NAMES = {"weather_pct": "weather_impact_pct"}
SERVICE_AIRLINE_NAMES = {"avg_delay_min": "avg_delay_minutes", "weather_pct": "weather_impact_pct"}
METADATA = "departure_delay_min string, weather_flag string, status string"


def service_days_back(days_back: int) -> int:
    """The service's rule: anything below one day means the default week."""
    return days_back if days_back >= 1 else DEFAULT_DAYS_BACK


def tool_days_back(days_back: int) -> int:
    """The tools' rule: clamp into 1..30."""
    return max(1, min(int(days_back), MAX_DAYS_BACK))


def optional_filters(rows: DataFrame, airline: str | None = None, route: str | None = None):
    """Equality on airline and route, each only when given."""
    if airline:
        rows = rows.where(F.col("airline") == F.lit(airline))
    if route:
        rows = rows.where(F.col("route") == F.lit(route))
    return rows


def days_back_filter(rows: DataFrame, day: str, as_of: dt.date, days_back: int) -> DataFrame:
    return rows.where(since(F.col(day), as_of, days_back))


def recent_flights(silver: DataFrame, as_of: dt.date, days_back: int) -> DataFrame:
    """Flights whose event day lies in the window.

    ``ingest_date`` is the day of ``event_ts``, so filtering it gives the same
    rows and prunes Silver's day folders.
    """
    return days_back_filter(silver, "ingest_date", as_of, days_back)


def document_measures(documents: DataFrame) -> DataFrame:
    """The document columns that facts use; the JSON is parsed once per row."""
    metadata = F.from_json("metadata", METADATA)
    return documents.select("airline", "route", "event_date", metadata.alias("m")).select(
        "airline",
        "route",
        "event_date",
        F.col("m.departure_delay_min").try_cast("double").alias("delay_min"),
        F.lower("m.weather_flag").alias("weather_text"),
        F.col("m.status").alias("status"),
    )


def recent_documents(
    documents: DataFrame,
    as_of: dt.date,
    days_back: int,
    airline: str | None = None,
    route: str | None = None,
) -> DataFrame:
    recent = days_back_filter(documents, "event_date", as_of, days_back)
    return optional_filters(recent, airline, route)


def pair_facts(recent: DataFrame) -> DataFrame:
    """Delay facts for every airline and route among the given documents."""
    return (
        document_measures(recent)
        .groupBy("airline", "route")
        .agg(
            F.count("*").alias("flight_count"),
            mean(F.col("delay_min"), 1).alias("avg_delay_min"),
            percent(F.col("weather_text") == "true").alias("weather_pct"),
            percent(F.col("status") == "DELAYED").alias("delayed_pct"),
        )
    )


def rag_facts(
    documents: DataFrame,
    as_of: dt.date,
    days_back: int = DEFAULT_DAYS_BACK,
    airline: str | None = None,
    route: str | None = None,
    top: int = 10,
) -> DataFrame:
    """Delay facts per airline and route, the slowest first."""
    recent = recent_documents(documents, as_of, days_back, airline, route)
    return (
        pair_facts(recent).orderBy(F.desc("avg_delay_min"), "airline", "route").limit(top)
    )


def best_for_filters(
    wanted: DataFrame, rows: DataFrame, order: list[Column], top: int, within: list[str] = ()
) -> DataFrame:
    """For every filter setting in ``wanted`` its best rows, ranked as ``fact_rank`` from 1.

    wanted: (within..., f_airline, f_route), a null filter standing for none. Each
    kind of setting that occurs (with and without either filter) has its own
    ranking, which keeps ``top`` rows per key already in the map tasks, so rows are
    never copied to the settings that could reach them. Both sides are stored, as
    every kind reads them. Where nothing tells settings apart, the ``top`` rows are
    one array that each setting unfolds.
    """
    wanted, rows = materialise(wanted, "wanted"), materialise(rows, "ranked")
    others = [c for c in rows.columns if c not in within]
    given = [F.col("f_airline").isNotNull(), F.col("f_route").isNotNull()]
    kinds = wanted.select(*given).distinct().collect()
    found = []
    for by_airline, by_route in kinds or [(False, False)]:
        filters = ["airline"] * by_airline + ["route"] * by_route
        asking = wanted.where((given[0] == F.lit(by_airline)) & (given[1] == F.lit(by_route)))
        if within or filters:
            found.append(_best_per_key(asking, rows, order, top, within, filters))
            continue
        rank = F.row_number().over(Window.orderBy(*order)).alias("fact_rank")
        best = rows.orderBy(*order).limit(top).select(F.struct(*others, rank).alias("best"))
        listed = asking.withColumn("best", best.agg(F.collect_list("best")).scalar())
        found.append(listed.select(*wanted.columns, F.inline("best")))
    return reduce(DataFrame.unionByName, found)


def _best_per_key(
    asking: DataFrame, rows: DataFrame, order: list[Column], top: int, within: list[str], filters: list[str]
) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*within, *filters).orderBy(*order))
    best = rows.withColumn("fact_rank", rank).where(F.col("fact_rank") <= top)
    same = [F.col(f"w.{k}") == F.col(f"b.{k}") for k in within]
    same += [F.col(f"w.f_{k}") == F.col(f"b.{k}") for k in filters]
    told = [F.col(f"b.{c}") for c in best.columns if c not in within]
    return asking.alias("w").join(best.alias("b"), same).select("w.*", *told)


def slowest_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs ranked within their airline, the slowest first."""
    order = Window.partitionBy("airline").orderBy(F.desc("avg_delay_min"), "route")
    return pairs.withColumn("fact_rank", F.row_number().over(order))


def delay_risk(
    documents: DataFrame,
    as_of: dt.date,
    airline: str = "",
    route: str = "",
    days_back: int = DEFAULT_DAYS_BACK,
) -> DataFrame:
    """The risk worker's five slowest airline-route pairs."""
    return rag_facts(
        documents, as_of, tool_days_back(days_back), airline.upper(), route.upper(), top=5
    )


def route_risk_facts(routes: DataFrame, route: str | None = None, severe: bool = True) -> DataFrame:
    """Risk rates in per cent, the riskiest routes first."""

    def rate(name: str, alias: str) -> Column:
        return F.round(F.col(name) * F.lit(100.0), 1).alias(alias)

    columns = [
        "route",
        F.col("total_flights").alias("flight_count"),
        F.round("risk_score", 2).alias("avg_risk_score"),
        rate("disruption_rate", "disruption_pct"),
        *([rate("severe_delay_rate", "severe_delay_pct")] if severe else []),
        rate("weather_impact_rate", "weather_impact_pct"),
    ]
    return (
        optional_filters(routes, route=route)
        .select(*columns)
        .orderBy(F.desc("avg_risk_score"), "route")
        .limit(10)
    )


def airline_facts(
    silver: DataFrame, as_of: dt.date, days_back: int, airline: str | None = None
) -> DataFrame:
    """Delay facts per airline; here delayed means more than 15 minutes late."""
    return (
        optional_filters(recent_flights(silver, as_of, days_back), airline)
        .groupBy("airline")
        .agg(
            F.count("*").alias("flight_count"),
            mean(F.col("departure_delay_min"), 1).alias("avg_delay_min"),
            percent(F.col("departure_delay_min") > LATE_DEPARTURE_MIN).alias("delayed_pct"),
            percent(F.col("weather_flag")).alias("weather_pct"),
        )
        .orderBy(F.desc("avg_delay_min"), "airline")
        .limit(10)
    )


def weather_facts(silver: DataFrame, as_of: dt.date, days_back: int) -> DataFrame:
    flights = recent_flights(silver, as_of, days_back)
    affected = F.col("weather_flag")
    return flights.agg(
        F.count("*").alias("total_flights"),
        F.count_if(affected).alias("weather_affected"),
        percent(affected).alias("weather_pct"),
        mean(F.when(affected, F.col("departure_delay_min")), 1).alias("avg_delay_if_weather"),
    )


def weather_impact(
    documents: DataFrame, as_of: dt.date, airline: str = "", days_back: int = DEFAULT_DAYS_BACK
) -> DataFrame:
    """Delay with and without weather; a document without the flag is in neither mean."""
    recent = recent_documents(documents, as_of, tool_days_back(days_back), airline.upper())
    weather = F.col("weather_text") == "true"
    return document_measures(recent).agg(
        F.count("*").alias("total_flights"),
        F.count_if(weather).alias("weather_affected"),
        percent(weather).alias("weather_pct"),
        mean(F.when(weather, F.col("delay_min")), 1).alias("avg_delay_if_weather"),
        mean(F.when(~weather, F.col("delay_min")), 1).alias("avg_delay_if_not_weather"),
    )


def generic_facts(silver: DataFrame, as_of: dt.date, days_back: int) -> DataFrame:
    flights = recent_flights(silver, as_of, days_back)
    return flights.agg(
        F.count("*").alias("total_flights"),
        F.count_distinct("airline").alias("airline_count"),
        F.count_distinct(F.concat("origin", F.lit("-"), "destination")).alias("route_count"),
        mean(F.col("departure_delay_min"), 1).alias("avg_delay_minutes"),
    )


def rag_status(documents: DataFrame, earliest: bool = True) -> DataFrame:
    columns = [
        F.max("event_date").alias("last_ingest_date"),
        *([F.min("event_date").alias("earliest_ingest_date")] if earliest else []),
        F.count("*").alias("rag_document_count"),
        F.count_distinct("airline").alias("airline_count"),
    ]
    return documents.agg(*columns)


def rag_freshness(documents: DataFrame, now: dt.datetime) -> DataFrame:
    """Documents in total, with a vector, and renewed within a day."""
    fresh_since = (now - dt.timedelta(hours=24)).strftime("%Y-%m-%d %H:%M:%S.%f")
    fresh = F.col("updated_ts").cast("timestamp_ntz") >= F.lit(fresh_since).cast("timestamp_ntz")
    return documents.agg(
        F.count("*").alias("total_docs"),
        F.count_if(F.size("embedding") > 0).alias("docs_with_embeddings"),
        F.count_if(fresh).alias("fresh_docs_24h"),
    )


def with_source(rows: DataFrame, source: str) -> DataFrame:
    return rows.withColumn("source", F.lit(source))


def service_facts(
    query_type: str,
    documents: DataFrame | None,
    silver: DataFrame | None,
    routes: DataFrame | None,
    as_of: dt.date,
    airline: str | None = None,
    route: str | None = None,
    days_back: int = DEFAULT_DAYS_BACK,
) -> DataFrame:
    """The service's facts: documents first, else the report the question asks for.

    A grouped report is empty exactly when its filtered input is, so the choice
    needs only the first matching row, not a run of the report.
    """
    days_back = service_days_back(days_back)
    if documents is not None:
        if not recent_documents(documents, as_of, days_back, airline, route).isEmpty():
            found = rag_facts(documents, as_of, days_back, airline, route)
            found = found.withColumnsRenamed(SERVICE_PAIR_NAMES).select(*SERVICE_PAIR_ORDER)
            return with_source(found, SOURCE_DOCUMENTS)
    kind = query_type.lower()
    if kind in RISK_TYPES:
        return with_source(route_risk_facts(routes, route), "secondary")
    if kind in AIRLINE_TYPES:
        found = airline_facts(silver, as_of, days_back, airline)
        return with_source(found.withColumnsRenamed(SERVICE_AIRLINE_NAMES), "secondary")
    if kind in WEATHER_TYPES:
        return with_source(weather_facts(silver, as_of, days_back), "secondary")
    return with_source(generic_facts(silver, as_of, days_back), "secondary")


def query_analytics(
    query_type: str,
    documents: DataFrame,
    silver: DataFrame | None,
    routes: DataFrame | None,
    as_of: dt.date,
    airline: str = "",
    route: str = "",
    days_back: int = DEFAULT_DAYS_BACK,
) -> DataFrame:
    """The agent's facts: the asked report first, documents when it has no rows.

    The risk report, ten rows at most, is stored to see whether it has any.
    """
    days_back = tool_days_back(days_back)
    airline, route = airline.upper(), route.upper()
    if query_type in AGENT_RISK_TYPES and routes is not None:
        found = materialise(route_risk_facts(routes, route, severe=False), "risk")
        if not found.isEmpty():
            return with_source(found, "primary")
    elif query_type in AIRLINE_TYPES and silver is not None:
        if not optional_filters(recent_flights(silver, as_of, days_back), airline).isEmpty():
            return with_source(airline_facts(silver, as_of, days_back, airline), "primary")
    elif query_type in AGENT_WEATHER_TYPES and silver is not None:
        return with_source(weather_facts(silver, as_of, days_back), "primary")
    elif query_type not in AGENT_RISK_TYPES + AIRLINE_TYPES + AGENT_WEATHER_TYPES:
        return with_source(
            rag_facts(documents, as_of, days_back, airline, route), "primary"
        )
    return with_source(rag_facts(documents, as_of, days_back, airline, route), SOURCE_DOCUMENTS)


def freshness_status(
    gold: DataFrame | None, documents: DataFrame, brief: bool = False
) -> DataFrame:
    """Freshness from Gold, or from the documents while Gold is missing or empty.

    The workers' brief form leaves out the day and on-time rows and the
    earliest document.
    """
    if gold is None or gold.isEmpty():
        return with_source(rag_status(documents, earliest=not brief), SOURCE_DOCUMENTS)
    status = gold_refresh(gold)
    if brief:
        status = status.drop("delayed_day_rows", "on_time_rows")
    return with_source(status, SOURCE_GOLD)


def mitigation_decision(risk_rows: DataFrame) -> DataFrame:
    """The advised action for each risk row."""
    return risk_rows.withColumn("decision", decision(F.col("avg_delay_min"), F.col("weather_pct")))


def decision(avg_delay_min: Column, weather_pct: Column) -> Column:
    return (
        F.when(weather_pct >= WEATHER_EVENT_PCT, DECISION_WEATHER)
        .when(avg_delay_min > ESCALATION_DELAY_MIN, DECISION_ESCALATE)
        .otherwise(DECISION_NONE)
    )
