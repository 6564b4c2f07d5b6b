"""Report views over Gold and Silver."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.constants import (
    BY_AIRLINE,
    BY_ROUTE,
    DELAYED_BY_DAY,
    DISRUPTED_STATUSES,
    ON_TIME_PCT,
    RISK_WEIGHTS,
    SEVERE_DELAY_MIN,
)
from flightlake.functions.measures import share, short_number
from flightlake.functions.times import event_timestamp, since


def _performance(gold: DataFrame, summary_type: str, key: str) -> DataFrame:
    return gold.where(F.col("summary_type") == summary_type).select(
        F.col("dimension_key").alias(key),
        "avg_dep_delay_min",
        "avg_arr_delay_min",
        "total_flights",
        "generated_ts",
    )


def bi_airline_performance(gold: DataFrame) -> DataFrame:
    return _performance(gold, BY_AIRLINE, "airline")


def bi_route_performance(gold: DataFrame) -> DataFrame:
    return _performance(gold, BY_ROUTE, "route")


def bi_daily_delays(gold: DataFrame) -> DataFrame:
    return gold.where(F.col("summary_type") == DELAYED_BY_DAY).select(
        F.col("dimension_key").try_cast("date").alias("delay_date"),
        F.col("total_flights").alias("delayed_flights"),
        "generated_ts",
    )


def last_30_days(daily_delays: DataFrame, as_of: dt.date) -> DataFrame:
    """The dashboard's default date range."""
    return daily_delays.where(since(F.col("delay_date"), as_of, 30))


def gold_refresh(gold: DataFrame) -> DataFrame:
    """Freshness snapshot of Gold: newest row, rows per summary, flights counted."""

    def rows_of(summary_type: str) -> Column:
        return F.count_if(F.col("summary_type") == summary_type)

    return gold.agg(
        F.max("generated_ts").alias("last_generated_ts"),
        F.count("*").alias("gold_summary_rows"),
        rows_of(BY_AIRLINE).alias("airline_rows"),
        rows_of(BY_ROUTE).alias("route_rows"),
        rows_of(DELAYED_BY_DAY).alias("delayed_day_rows"),
        rows_of(ON_TIME_PCT).alias("on_time_rows"),
        F.sum("total_flights").alias("total_flights_across_summaries"),
    )


def last_refresh(gold: DataFrame) -> DataFrame:
    return gold_refresh(gold).select("last_generated_ts")


def _read_flights(silver: DataFrame) -> DataFrame:
    """Silver with defensive casts, as exported files may hold text."""
    return silver.select(
        "flight_id",
        "airline",
        "origin",
        "destination",
        F.concat("origin", F.lit("-"), "destination").alias("route"),
        "event_ts",
        F.col("departure_delay_min").try_cast("bigint").alias("departure_delay_min"),
        F.col("arrival_delay_min").try_cast("bigint").alias("arrival_delay_min"),
        F.col("weather_flag").try_cast("boolean").alias("weather_flag"),
        "status",
    )


def delay_driver() -> Column:
    """Main cause of a delay; the first rule that holds names it."""
    return (
        F.when(F.col("weather_flag"), "WEATHER")
        .when(F.col("departure_delay_min") >= SEVERE_DELAY_MIN, "SEVERE_DEP_DELAY")
        .when(F.col("arrival_delay_min") >= SEVERE_DELAY_MIN, "SEVERE_ARR_DELAY")
        .when(F.col("status") == "CANCELLED", "CANCELLATION")
        .when(F.col("status") == "DIVERTED", "DIVERSION")
        .otherwise("OPERATIONAL")
    )


def delay_explanations(silver: DataFrame) -> DataFrame:
    """Flight rows with route, a normalised timestamp and the delay driver."""
    flights = _read_flights(silver)
    if not isinstance(silver.schema["event_ts"].dataType, T.TimestampType):
        flights = flights.withColumn("event_ts", event_timestamp(F.col("event_ts")))
    return flights.withColumn("primary_delay_driver", delay_driver())


def route_risk(silver: DataFrame) -> DataFrame:
    """Disruption, severity and weather rates per route and their weighted score."""
    severe = (F.col("departure_delay_min") >= SEVERE_DELAY_MIN) | (
        F.col("arrival_delay_min") >= SEVERE_DELAY_MIN
    )
    rates = (
        _read_flights(silver)
        .groupBy("route")
        .agg(
            F.min("airline").alias("dominant_airline"),
            F.count("*").alias("total_flights"),
            share(F.col("status").isin(DISRUPTED_STATUSES)).alias("disruption_rate"),
            share(severe).alias("severe_delay_rate"),
            share(F.col("weather_flag")).alias("weather_impact_rate"),
            F.avg("departure_delay_min").alias("avg_departure_delay_min"),
            F.avg("arrival_delay_min").alias("avg_arrival_delay_min"),
        )
    )
    weighted = (
        F.lit(RISK_WEIGHTS["disruption"]) * F.col("disruption_rate")
        + F.lit(RISK_WEIGHTS["severe"]) * F.col("severe_delay_rate")
        + F.lit(RISK_WEIGHTS["weather"]) * F.col("weather_impact_rate")
    )
    return rates.withColumn("risk_score", F.round(F.lit(100.0) * weighted, 2))


def nl_facts(routes: DataFrame, airlines: DataFrame) -> DataFrame:
    """Facts in words and as JSON, from route risk and airline performance rows."""

    def fact(rows: DataFrame, kind: str, key: str, sentence: Column) -> DataFrame:
        fields = [name for name in rows.columns if name != key]
        return rows.select(
            F.lit(kind).alias("fact_type"),
            F.col(key).alias("fact_key"),
            F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("fact_payload"),
            sentence.alias("narrative_text"),
        )

    def rate(name: str) -> Column:
        return short_number(F.round(F.col(name) * F.lit(100.0), 2))

    route_text = F.concat(
        F.lit("Route "), F.col("route"),
        F.lit(" risk score is "), short_number(F.col("risk_score")),
        F.lit(" with disruption rate "), rate("disruption_rate"),
        F.lit("% and weather impact "), rate("weather_impact_rate"),
        F.lit("%."),
    )
    airline_text = F.concat(
        F.lit("Airline "), F.col("airline"),
        F.lit(" average departure delay is "), short_number(F.col("avg_dep_delay_min")),
        F.lit(" minutes across "), F.col("total_flights").cast("string"),
        F.lit(" flights."),
    )
    return fact(routes, "route_risk", "route", route_text).unionByName(
        fact(airlines, "airline_performance", "airline", airline_text)
    )


def kpi_banner(airlines: DataFrame) -> DataFrame:
    return airlines.agg(
        F.sum("total_flights").alias("total_flights"),
        F.round(F.avg("avg_dep_delay_min"), 6).alias("avg_dep_delay_min"),
        F.round(F.avg("avg_arr_delay_min"), 6).alias("avg_arr_delay_min"),
    )


def delay_leaderboard(airlines: DataFrame) -> DataFrame:
    return airlines.select("airline", "avg_dep_delay_min").orderBy(
        F.desc("avg_dep_delay_min"), "airline"
    )


def daily_delay_trend(daily_delays: DataFrame) -> DataFrame:
    return daily_delays.select("delay_date", "delayed_flights").orderBy("delay_date")


def weather_share_by_airline(silver: DataFrame) -> DataFrame:
    """Delayed flights of an airline, split by weather and everything else."""
    delayed = F.col("status") == "DELAYED"
    weather = F.coalesce(F.col("weather_flag"), F.lit(False))
    return silver.groupBy("airline").agg(
        F.count_if(delayed & weather).alias("weather_delays"),
        F.count_if(delayed & ~weather).alias("other_delays"),
    )
