"""Silver rules, Gold and report views."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import rnd, short_number, sql
from flightlake.functions.times import event_timestamp
from flightlake.operators import gold as gold_ops
from flightlake.operators import quality, views
from flightlake.plans import daily_gold
from flightlake.plans.medallion import riskiest_routes
from flightlake.session import work_folder
from flightlake.sources import tables

FLIGHT_COLUMNS = (
    "flight_id, airline, origin, destination, departure_delay_min, arrival_delay_min, "
    "weather_flag, status, event_ts"
)


@query("silver_typed", sql(f"SELECT {FLIGHT_COLUMNS} FROM typed"))
def silver_typed(spark, sf):
    return quality.silver_typed(fx.flights(spark, sf))


@query("ingest_date", sql("SELECT flight_id, event_ts, ingest_date FROM typed"))
def ingest_date(spark, sf):
    typed = quality.silver_typed(fx.flights(spark, sf))
    return quality.ingest_date(typed).select("flight_id", "event_ts", "ingest_date")


@query("drop_missing_keys", sql("SELECT * FROM keyed"))
def drop_missing_keys(spark, sf):
    typed = quality.ingest_date(quality.silver_typed(fx.flights(spark, sf)))
    return quality.drop_missing_keys(typed)


@query(
    "delay_range",
    sql(
        f"SELECT {FLIGHT_COLUMNS} FROM typed WHERE departure_delay_min BETWEEN -60 AND 600 "
        "AND arrival_delay_min BETWEEN -60 AND 600"
    ),
)
def delay_range(spark, sf):
    return quality.delay_range(quality.silver_typed(fx.flights(spark, sf)))


@query("no_self_route", sql(f"SELECT {FLIGHT_COLUMNS} FROM typed WHERE origin <> destination"))
def no_self_route(spark, sf):
    return quality.no_self_route(quality.silver_typed(fx.flights(spark, sf)))


@query("dedup_flights", sql("SELECT * FROM silver"))
def dedup_flights(spark, sf):
    return quality.dedup_flights(quality.clean_flights(fx.flights(spark, sf)))


@query("dedup_flights_any", sql("SELECT DISTINCT flight_id FROM silver"))
def dedup_flights_any(spark, sf):
    return quality.silver_flights(fx.flights(spark, sf), any_survivor=True).select("flight_id")


@query("silver_flights", sql("SELECT * FROM silver"))
def silver_flights(spark, sf):
    return fx.silver(spark, sf)


@query(
    "silver_from_text",
    sql("SELECT * FROM silver"),
)
def silver_from_text(spark, sf):
    return quality.silver_flights(fx.flights_text(spark, sf))


@query(
    "quality_metrics",
    sql(
        """
        SELECT raw_rows, raw_rows - keyed_rows AS missing_keys,
          keyed_rows - ranged_rows AS out_of_range, ranged_rows - passing_rows AS self_routes,
          passing_rows - clean_rows AS duplicates, clean_rows,
          raw_rows - clean_rows AS dropped_rows,
          coalesce(CAST(raw_rows - clean_rows AS DOUBLE) * CAST(100.0 AS DOUBLE)
            / nullif(raw_rows, 0), 0) AS dropped_pct
        FROM (SELECT (SELECT count(*) FROM typed) AS raw_rows,
                (SELECT count(*) FROM keyed) AS keyed_rows,
                (SELECT count(*) FROM ranged) AS ranged_rows,
                (SELECT count(*) FROM passing) AS passing_rows,
                (SELECT count(*) FROM silver) AS clean_rows) n"""
    ),
)
def quality_metrics(spark, sf):
    return quality.quality_metrics(fx.flights(spark, sf))


@query("valid_records", sql("SELECT * EXCLUDE (reject_reason) FROM reasons WHERE reject_reason IS NULL"))
def valid_records(spark, sf):
    return quality.valid_records(fx.flights_text(spark, sf))


@query("rejected_records", sql("SELECT * FROM reasons WHERE reject_reason IS NOT NULL"))
def rejected_records(spark, sf):
    return quality.rejected_records(fx.flights_text(spark, sf))


@query(
    "bad_row_metrics",
    sql("SELECT reject_reason, count(*) AS records FROM reasons GROUP BY reject_reason"),
)
def bad_row_metrics(spark, sf):
    return quality.bad_row_metrics(fx.flights_text(spark, sf))


# --- Gold ---


@query("avg_delay_by_airline", sql("SELECT *, dimension_key AS airline FROM by_airline"))
def avg_delay_by_airline(spark, sf):
    return gold_ops.avg_delay_by_airline(fx.silver(spark, sf))


@query("avg_delay_by_route", sql("SELECT *, dimension_key AS route FROM by_route"))
def avg_delay_by_route(spark, sf):
    return gold_ops.avg_delay_by_route(fx.silver(spark, sf))


@query("delayed_by_day", sql("SELECT *, CAST(dimension_key AS DATE) AS ingest_date FROM by_day"))
def delayed_by_day(spark, sf):
    return gold_ops.delayed_by_day(fx.silver(spark, sf))


@query("ontime_pct_by_airline", sql("SELECT *, dimension_key AS airline FROM on_time"))
def ontime_pct_by_airline(spark, sf):
    return gold_ops.ontime_pct_by_airline(fx.silver(spark, sf))


@query("prune_columns", sql("SELECT * EXCLUDE (on_time_pct) FROM on_time"))
def prune_columns(spark, sf):
    return gold_ops.ontime_pct_by_airline(fx.silver(spark, sf)).select(*gold_ops.SUMMARY_COLUMNS)


@query(
    "union_constants",
    sql("SELECT summary_type, avg_dep_delay_min, avg_arr_delay_min FROM by_day"),
)
def union_constants(spark, sf):
    return gold_ops.delayed_by_day(fx.silver(spark, sf)).select(
        "summary_type", "avg_dep_delay_min", "avg_arr_delay_min"
    )


@query("gold_union", sql("SELECT * FROM gold_rows"))
def gold_union(spark, sf):
    return gold_ops.gold_union(fx.silver(spark, sf))


@query("gold_summary", sql("SELECT * FROM gold"))
def gold_summary(spark, sf):
    return fx.gold(spark, sf)


@query("gold_daily", sql("SELECT * FROM gold"))
def gold_daily(spark, sf):
    """Gold after Silver has grown by its last ten days, which alone are summed by the second refresh."""
    name = f"daily_{uuid.uuid4().hex}"
    silver = fx.silver(spark, sf)
    cut = F.date_sub(F.lit(fx.AS_OF), 10)
    tables.write_silver(silver.where(F.col("ingest_date") < cut), f"{name}_silver", work_folder(spark, "silver"))
    daily_gold.refresh_gold(spark, f"{name}_silver", f"{name}_sums", f"{name}_gold", fx.NOW)
    rest = silver.where(F.col("ingest_date") >= cut)
    rest.write.mode("append").format("parquet").partitionBy("ingest_date").saveAsTable(f"{name}_silver")
    daily_gold.refresh_gold(spark, f"{name}_silver", f"{name}_sums", f"{name}_gold", fx.NOW)
    return spark.table(f"{name}_gold")


@query(
    "counts",
    sql(
        "SELECT 'silver' AS table_name, count(*) AS row_count FROM silver "
        "UNION ALL SELECT 'gold' AS table_name, count(*) AS row_count FROM gold"
    ),
)
def counts(spark, sf):
    silver = fx.silver(spark, sf)
    return gold_ops.counts(silver, gold_ops.gold_summary(silver, fx.NOW))


# --- Views ---


@query("bi_airline_performance", sql("SELECT * FROM airlines"))
def bi_airline_performance(spark, sf):
    return views.bi_airline_performance(fx.gold(spark, sf))


@query(
    "bi_route_performance",
    sql(
        "SELECT dimension_key AS route, avg_dep_delay_min, avg_arr_delay_min, total_flights, "
        "generated_ts FROM gold WHERE summary_type = 'by_route'"
    ),
)
def bi_route_performance(spark, sf):
    return views.bi_route_performance(fx.gold(spark, sf))


@query("bi_daily_delays", sql("SELECT * FROM daily"))
def bi_daily_delays(spark, sf):
    return views.bi_daily_delays(fx.gold(spark, sf))


@query("last_30_days", sql("SELECT * FROM daily WHERE delay_date >= DATE '2024-01-11'"))
def last_30_days(spark, sf):
    return views.last_30_days(views.bi_daily_delays(fx.gold(spark, sf)), fx.LOG_NOW.date())


@query("daily_delay_trend", sql("SELECT delay_date, delayed_flights FROM daily ORDER BY delay_date"))
def daily_delay_trend(spark, sf):
    return views.daily_delay_trend(views.bi_daily_delays(fx.gold(spark, sf)))


@query(
    "gold_refresh",
    sql(
        """
        SELECT max(generated_ts) AS last_generated_ts, count(*) AS gold_summary_rows,
          count(*) FILTER (WHERE summary_type = 'by_airline') AS airline_rows,
          count(*) FILTER (WHERE summary_type = 'by_route') AS route_rows,
          count(*) FILTER (WHERE summary_type = 'delayed_by_day') AS delayed_day_rows,
          count(*) FILTER (WHERE summary_type = 'on_time_pct') AS on_time_rows,
          CAST(sum(total_flights) AS BIGINT) AS total_flights_across_summaries
        FROM gold"""
    ),
)
def gold_refresh(spark, sf):
    return views.gold_refresh(fx.gold(spark, sf))


@query("last_refresh", sql("SELECT max(generated_ts) AS last_generated_ts FROM gold"))
def last_refresh(spark, sf):
    return views.last_refresh(fx.gold(spark, sf))


DRIVER = """CASE WHEN weather_flag THEN 'WEATHER'
  WHEN departure_delay_min >= 60 THEN 'SEVERE_DEP_DELAY'
  WHEN arrival_delay_min >= 60 THEN 'SEVERE_ARR_DELAY'
  WHEN status = 'CANCELLED' THEN 'CANCELLATION' WHEN status = 'DIVERTED' THEN 'DIVERSION'
  ELSE 'OPERATIONAL' END"""


@query(
    "delay_explanations",
    sql(
        "SELECT flight_id, airline, origin, destination, route, event_ts, "
        "CAST(departure_delay_min AS BIGINT) AS departure_delay_min, "
        "CAST(arrival_delay_min AS BIGINT) AS arrival_delay_min, weather_flag, status, "
        f"{DRIVER} AS primary_delay_driver FROM routed"
    ),
)
def delay_explanations(spark, sf):
    return views.delay_explanations(fx.silver(spark, sf))


@query(
    "delay_driver",
    sql(f"SELECT {DRIVER} AS driver, count(*) AS flights FROM silver GROUP BY 1"),
)
def delay_driver(spark, sf):
    drivers = fx.silver(spark, sf).select(views.delay_driver().alias("driver"))
    return drivers.groupBy("driver").agg(F.count("*").alias("flights"))


@query("event_ts_norm", sql("SELECT event_id, ts AS event_ts FROM events"))
def event_ts_norm(spark, sf):
    """Half of the timestamps are written as epoch microseconds, half as text."""
    events = fx.table(spark, sf, "events")
    written = F.when(
        F.col("event_id") % 2 == 0, F.unix_micros(F.col("ts").cast("timestamp")).cast("string")
    ).otherwise(F.col("ts").cast("string"))
    return events.select("event_id", event_timestamp(written).alias("event_ts"))


@query("route_risk", sql("SELECT * FROM routes"))
def route_risk(spark, sf):
    return views.route_risk(fx.silver(spark, sf))


ROUTE_FACTS = f"""
  SELECT route, total_flights AS flight_count, {rnd('risk_score', 2)} AS avg_risk_score,
    {rnd('disruption_rate * CAST(100.0 AS DOUBLE)', 1)} AS disruption_pct,
    {rnd('severe_delay_rate * CAST(100.0 AS DOUBLE)', 1)} AS severe_delay_pct,
    {rnd('weather_impact_rate * CAST(100.0 AS DOUBLE)', 1)} AS weather_impact_pct
  FROM routes"""


@query(
    "riskiest_routes",
    sql(f"{ROUTE_FACTS} ORDER BY avg_risk_score DESC, route LIMIT 10"),
)
def riskiest(spark, sf):
    return riskiest_routes(fx.flights(spark, sf))


@query(
    "nl_facts",
    sql(
        f"""
        SELECT 'route_risk' AS fact_type, route AS fact_key,
          'Route ' || route || ' risk score is ' || {short_number('risk_score')}
          || ' with disruption rate '
          || {short_number(rnd('disruption_rate * CAST(100.0 AS DOUBLE)', 2))}
          || '% and weather impact '
          || {short_number(rnd('weather_impact_rate * CAST(100.0 AS DOUBLE)', 2))}
          || '%.' AS narrative_text,
          CAST(total_flights AS BIGINT) AS payload_flights,
          {rnd('risk_score', 6)} AS payload_number, dominant_airline AS payload_airline,
          {rnd('disruption_rate', 6)} AS payload_disruption, {rnd('severe_delay_rate', 6)} AS payload_severe,
          {rnd('weather_impact_rate', 6)} AS payload_weather, CAST(NULL AS DOUBLE) AS payload_arrival
        FROM routes
        UNION ALL
        SELECT 'airline_performance' AS fact_type, airline AS fact_key,
          'Airline ' || airline || ' average departure delay is '
          || {short_number('avg_dep_delay_min')} || ' minutes across '
          || CAST(total_flights AS VARCHAR) || ' flights.' AS narrative_text,
          total_flights AS payload_flights, {rnd('avg_dep_delay_min', 6)} AS payload_number,
          NULL AS payload_airline, NULL AS payload_disruption, NULL AS payload_severe,
          NULL AS payload_weather, {rnd('avg_arr_delay_min', 6)} AS payload_arrival
        FROM airlines"""
    ),
)
def nl_facts(spark, sf):
    """The payload is compared by its parsed fields, as number texts differ by engine."""
    silver = fx.silver(spark, sf)
    airlines = views.bi_airline_performance(gold_ops.gold_summary(silver, fx.NOW))
    facts = views.nl_facts(views.route_risk(silver), airlines)

    def field(name):
        return F.get_json_object("fact_payload", f"$.{name}")

    number = F.coalesce(field("risk_score"), field("avg_dep_delay_min")).cast("double")
    return facts.select(
        "fact_type",
        "fact_key",
        "narrative_text",
        field("total_flights").cast("bigint").alias("payload_flights"),
        F.round(number, 6).alias("payload_number"),
        field("dominant_airline").alias("payload_airline"),
        *[
            F.round(field(name).cast("double"), 6).alias(f"payload_{short}")
            for short, name in {
                "disruption": "disruption_rate",
                "severe": "severe_delay_rate",
                "weather": "weather_impact_rate",
                "arrival": "avg_arr_delay_min",
            }.items()
        ],
    )


@query(
    "kpi_banner",
    sql(
        "SELECT CAST(sum(total_flights) AS BIGINT) AS total_flights, "
        f"{rnd('avg(avg_dep_delay_min)', 6)} AS avg_dep_delay_min, "
        f"{rnd('avg(avg_arr_delay_min)', 6)} AS avg_arr_delay_min FROM airlines"
    ),
)
def kpi_banner(spark, sf):
    return views.kpi_banner(views.bi_airline_performance(fx.gold(spark, sf)))


@query(
    "delay_leaderboard",
    sql("SELECT airline, avg_dep_delay_min FROM airlines ORDER BY avg_dep_delay_min DESC, airline"),
)
def delay_leaderboard(spark, sf):
    return views.delay_leaderboard(views.bi_airline_performance(fx.gold(spark, sf)))


@query(
    "weather_share_by_airline",
    sql(
        "SELECT airline, count(*) FILTER (WHERE status = 'DELAYED' AND weather_flag) "
        "AS weather_delays, count(*) FILTER (WHERE status = 'DELAYED' AND NOT weather_flag) "
        "AS other_delays FROM silver GROUP BY airline"
    ),
)
def weather_share_by_airline(spark, sf):
    return views.weather_share_by_airline(fx.silver(spark, sf))
