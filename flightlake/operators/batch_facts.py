"""Facts for a whole batch of questions at once.

Instead of one report per question, flights are first summed by day, airline
and route: a cube whose size depends on the calendar and the network, not on
the number of flights or questions. Every window ends today, so its sums are a
running sum from today backwards, taken at its last day; each cube row is read
once, however many windows there are. The best rows are ranked per kind of
filter, and every question picks up the rows of its setting.
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
    DEFAULT_DAYS_BACK,
    LATE_DEPARTURE_MIN,
    MAX_DAYS_BACK,
    RISK_TYPES,
    SOURCE_DOCUMENTS,
    WEATHER_TYPES,
)
from flightlake.functions.text import blank_to_null, json_row_text
from flightlake.operators.facts import best_for_filters, document_measures
from flightlake.operators.requests import fact_pairs
from flightlake.session import materialise

SETTING = ["f_airline", "f_route", "days_back"]
FACTS_PER_QUESTION = 10
RAG_NAMES = [
    "airline",
    "route",
    "flight_count",
    "avg_delay_min",
    "weather_impact_pct",
    "delayed_pct",
]
ROUTE_NAMES = [
    "route",
    "flight_count",
    "avg_risk_score",
    "disruption_pct",
    "severe_delay_pct",
    "weather_impact_pct",
]
AIRLINE_NAMES = [
    "airline",
    "flight_count",
    "avg_delay_minutes",
    "delayed_pct",
    "weather_impact_pct",
]
WEATHER_NAMES = ["total_flights", "weather_affected", "weather_pct", "avg_delay_if_weather"]
GENERIC_NAMES = ["total_flights", "airline_count", "route_count", "avg_delay_minutes"]
#: What the agent's reports call a measure where the service's say otherwise.
AGENT_PAIR_NAMES = {"weather_impact_pct": "weather_pct"}
AGENT_AIRLINE_NAMES = {"avg_delay_minutes": "avg_delay_min", "weather_impact_pct": "weather_pct"}
AGENT_RAG = ["airline", "route", "flight_count", "avg_delay_min", "weather_pct", "delayed_pct"]
AGENT_ROUTE = [name for name in ROUTE_NAMES if name != "severe_delay_pct"]
AGENT_AIRLINE = ["airline", "flight_count", "avg_delay_min", "delayed_pct", "weather_pct"]


def with_setting(requests: DataFrame) -> DataFrame:
    """The filter setting of each request; an absent filter is null."""
    days = F.coalesce("days_back", F.lit(DEFAULT_DAYS_BACK))
    return requests.withColumns(
        {
            "f_airline": F.col("airline"),
            "f_route": F.col("route"),
            "days_back": F.when(days < 1, DEFAULT_DAYS_BACK).otherwise(days).cast("int"),
        }
    )


def report(query_type: Column) -> Column:
    """The report a query type names, as for a single question; anything else asks for the totals."""
    kind = F.lower(query_type)
    return (
        F.when(kind.isin(RISK_TYPES), "risk")
        .when(kind.isin(AIRLINE_TYPES), "airline")
        .when(kind.isin(WEATHER_TYPES), "weather")
        .otherwise("generic")
    )


def with_agent_setting(requests: DataFrame) -> DataFrame:
    """The filter setting by the agent's rules: 1 to 30 days, capitals, an empty filter is none."""
    days = F.coalesce("days_back", F.lit(DEFAULT_DAYS_BACK))
    return requests.withColumns(
        {
            "f_airline": blank_to_null(F.upper("airline")),
            "f_route": blank_to_null(F.upper("route")),
            "days_back": F.least(F.greatest(days, F.lit(1)), F.lit(MAX_DAYS_BACK)).cast("int"),
        }
    )


def agent_report(query_type: Column) -> Column:
    """The report the agent asks first; anything that names none asks the documents."""
    return (
        F.when(query_type.isin(AGENT_RISK_TYPES), "risk")
        .when(query_type.isin(AIRLINE_TYPES), "airline")
        .when(query_type.isin(AGENT_WEATHER_TYPES), "weather")
        .otherwise("documents")
    )


def windows_of(settings: DataFrame) -> list[int]:
    """The different windows that are asked for, in days: at most one number per day of the calendar."""
    return sorted(row["days_back"] for row in settings.select("days_back").distinct().collect())


def _in_reach(rows: DataFrame, day: str, windows: list[int], as_of: dt.date) -> DataFrame:
    """Rows of the longest window, with their ``age`` in days; a day after ``as_of`` counts as ``as_of``."""
    earliest = as_of - dt.timedelta(days=max(windows, default=0))
    age = F.greatest(F.datediff(F.lit(as_of), F.col(day)), F.lit(0))
    return rows.where(F.col(day) >= F.lit(earliest)).withColumn("age", age)


def window_sums(cube: DataFrame, keys: list[str], windows: list[int]) -> DataFrame:
    """(days_back, keys..., measures...): the sums of each window, one row per key and window that has any.

    Measures are summed per age, then run up from today. A running sum holds for
    every window from its own age to just below the next older one of its key.
    """
    measures = [c for c in cube.columns if c not in ("age", "airline", "route")]
    daily = cube.groupBy(*keys, "age").agg(*[F.sum(m).alias(m) for m in measures])
    newest_first = Window.partitionBy(*keys).orderBy("age")
    running = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = daily.select(
        *keys,
        "age",
        F.lead("age").over(newest_first).alias("older"),
        *[F.sum(m).over(running).alias(m) for m in measures],
    )
    asked = F.array(*[F.lit(w) for w in windows]).cast("array<int>")
    held = F.filter(asked, lambda w: (w >= F.col("age")) & F.coalesce(w < F.col("older"), F.lit(True)))
    return sums.select(F.explode(held).alias("days_back"), *keys, *measures)


def _pct(part: str, whole: str) -> Column:
    return F.round(F.try_divide(F.col(part).cast("double"), F.col(whole)) * F.lit(100.0), 1)


def _avg(total: str, known: str, digits: int = 1) -> Column:
    return F.round(F.try_divide(F.col(total), F.col(known)), digits)


def document_cube(documents: DataFrame, windows: list[int], as_of: dt.date) -> DataFrame:
    recent = _in_reach(document_measures(documents), "event_date", windows, as_of)
    return recent.groupBy("age", "airline", "route").agg(
        F.count("*").alias("flights"),
        F.sum("delay_min").alias("delay_total"),
        F.count("delay_min").alias("delay_known"),
        F.count_if(F.col("weather_text") == "true").alias("weather"),
        F.count_if(F.col("status") == "DELAYED").alias("delayed"),
    )


def flight_cube(silver: DataFrame, windows: list[int], as_of: dt.date) -> DataFrame:
    recent = _in_reach(silver, "ingest_date", windows, as_of)
    delay = F.col("departure_delay_min").cast("double")
    weather_delay = F.when(F.col("weather_flag"), delay)
    return recent.groupBy(
        "age", "airline", F.concat("origin", F.lit("-"), "destination").alias("route")
    ).agg(
        F.count("*").alias("flights"),
        F.sum(delay).alias("delay_total"),
        F.count(delay).alias("delay_known"),
        F.count_if("weather_flag").alias("weather"),
        F.sum(weather_delay).alias("weather_delay_total"),
        F.count(weather_delay).alias("weather_delay_known"),
        F.count_if(delay > LATE_DEPARTURE_MIN).alias("late"),
    )


def setting_rag_facts(settings: DataFrame, documents: DataFrame, as_of: dt.date) -> DataFrame:
    """The ten slowest airline-route pairs of every filter setting."""
    windows = windows_of(settings)
    sums = window_sums(document_cube(documents, windows, as_of), ["airline", "route"], windows)
    facts = sums.select(
        "days_back",
        "airline",
        "route",
        F.col("flights").alias("flight_count"),
        _avg("delay_total", "delay_known").alias("avg_delay_min"),
        _pct("weather", "flights").alias("weather_impact_pct"),
        _pct("delayed", "flights").alias("delayed_pct"),
    )
    order = [F.desc("avg_delay_min"), F.col("airline"), F.col("route")]
    return best_for_filters(settings, facts, order, FACTS_PER_QUESTION, ["days_back"])


def _airline_setting_facts(settings: DataFrame, cube: DataFrame) -> DataFrame:
    """The airline report knows no route: a route filter is left out of it."""
    facts = window_sums(cube, ["airline"], windows_of(settings)).select(
        "days_back",
        "airline",
        F.lit(None).cast("string").alias("route"),
        F.col("flights").alias("flight_count"),
        _avg("delay_total", "delay_known").alias("avg_delay_minutes"),
        _pct("late", "flights").alias("delayed_pct"),
        _pct("weather", "flights").alias("weather_impact_pct"),
    )
    order = [F.desc("avg_delay_minutes"), F.col("airline")]
    wanted = settings.withColumnRenamed("f_route", "own_route").withColumn(
        "f_route", F.lit(None).cast("string")
    )
    found = best_for_filters(wanted, facts, order, FACTS_PER_QUESTION, ["days_back"])
    return found.drop("f_route", "route").withColumnRenamed("own_route", "f_route")


def _totals(settings: DataFrame, cube: DataFrame, *measures: Column) -> DataFrame:
    """One row per setting, of its window alone; a window without flights still has its row."""
    sums = window_sums(cube, [], windows_of(settings))
    totals = settings.select("days_back").distinct().join(sums, "days_back", "left")
    counted = F.coalesce("flights", F.lit(0)).cast("bigint").alias("total_flights")
    return settings.join(totals.select("days_back", counted, *measures, F.lit(1).alias("fact_rank")), "days_back")


def _weather_setting_facts(settings: DataFrame, cube: DataFrame) -> DataFrame:
    return _totals(
        settings,
        cube,
        F.coalesce("weather", F.lit(0)).cast("bigint").alias("weather_affected"),
        _pct("weather", "flights").alias("weather_pct"),
        _avg("weather_delay_total", "weather_delay_known").alias("avg_delay_if_weather"),
    )


def first_seen(cube: DataFrame, key: str, name: str) -> DataFrame:
    """(age, name): how many keys occur at an age for the first time, counted back from today.

    Their running sum is the number of different keys in a window.
    """
    ages = cube.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("age").alias("age"))
    return ages.groupBy("age").agg(F.count("*").alias(name))


def _generic_setting_facts(settings: DataFrame, cube: DataFrame) -> DataFrame:
    distinct = {"airline": "airlines", "route": "routes"}
    counted = cube
    for key, name in distinct.items():
        counted = counted.unionByName(first_seen(cube, key, name), allowMissingColumns=True)
    return _totals(
        settings,
        counted,
        *[
            F.coalesce(name, F.lit(0)).cast("bigint").alias(f"{key}_count")
            for key, name in distinct.items()
        ],
        _avg("delay_total", "delay_known").alias("avg_delay_minutes"),
    )


def _route_setting_facts(settings: DataFrame, routes: DataFrame) -> DataFrame:
    """The risk report knows routes alone: airline and window are left out of it."""

    def rate(name: str) -> Column:
        return F.round(F.col(name) * F.lit(100.0), 1)

    scored = routes.select(
        F.lit(None).cast("string").alias("airline"),
        "route",
        F.col("total_flights").alias("flight_count"),
        F.round("risk_score", 2).alias("avg_risk_score"),
        rate("disruption_rate").alias("disruption_pct"),
        rate("severe_delay_rate").alias("severe_delay_pct"),
        rate("weather_impact_rate").alias("weather_impact_pct"),
    )
    wanted = settings.withColumnRenamed("f_airline", "own_airline").withColumn(
        "f_airline", F.lit(None).cast("string")
    )
    order = [F.desc("avg_risk_score"), F.col("route")]
    found = best_for_filters(wanted, scored, order, FACTS_PER_QUESTION)
    return found.drop("f_airline", "airline").withColumnRenamed("own_airline", "f_airline")


def _as_text(facts: DataFrame, names: list[str], source: str) -> DataFrame:
    return facts.select(
        *SETTING,
        F.col("fact_rank").cast("int").alias("fact_rank"),
        F.lit(source).alias("source"),
        json_row_text(names).alias("fact_json"),
        fact_pairs(names).alias("fact_pairs"),
    )


def batch_facts(
    requests: DataFrame,
    documents: DataFrame,
    silver: DataFrame,
    routes: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Facts of every request (``request_id, fact_rank, source, fact_json, fact_pairs``).

    As for a single question: the documents answer first; a setting they have
    no row for is answered by the report its query type names. The settings of
    the requests are stored, so that questions are checked once. The first
    answers (ten rows per setting at most) are stored, because they are both
    returned and used to see what is still open; Silver is read only for the
    reports that are, as far back as their longest window.
    """
    asked = with_setting(requests).withColumn("report", report(F.col("query_type")))
    keyed = materialise(asked.select("request_id", "report", *SETTING), "asked")
    settings = keyed.select(*SETTING).distinct()
    primary = materialise(
        _as_text(setting_rag_facts(settings, documents, as_of), RAG_NAMES, SOURCE_DOCUMENTS), "facts"
    )
    answered = primary.where(F.col("fact_rank") == 1).select(*SETTING)
    still_open = materialise(
        _by_setting(keyed.select(*SETTING, "report").distinct(), answered, "left_anti"), "open"
    )
    kinds = kinds_of(still_open)
    answers = _by_setting(keyed, primary, "inner")
    cube = _cube_for(kinds, silver, still_open, as_of)
    for kind in kinds:
        open_settings = still_open.where(F.col("report") == kind).select(*SETTING)
        rows, names = _report_rows(kind, open_settings, cube, routes)
        asking = keyed.where(F.col("report") == kind)
        found = _by_setting(asking, _as_text(rows, names, "secondary"), "inner")
        answers = answers.unionByName(found)
    return answers.select("request_id", "fact_rank", "source", "fact_json", "fact_pairs")


def agent_batch_facts(
    requests: DataFrame,
    documents: DataFrame,
    silver: DataFrame,
    routes: DataFrame,
    as_of: dt.date,
) -> DataFrame:
    """Facts of every request in the agent's order, with the columns of ``batch_facts``.

    The report that the query type names answers first (source ``primary``); a
    setting it has no row for is answered by the documents, and so is a query
    type that names no report (for these the documents are ``primary``). The
    weather report always has a row. Silver and the documents are each read only
    where a setting needs them, as far back as the longest window that does.
    """
    asked = with_agent_setting(requests).withColumn("report", agent_report(F.col("query_type")))
    keyed = materialise(asked.select("request_id", "report", *SETTING), "asked")
    settings = materialise(keyed.select("report", *SETTING).distinct(), "settings")
    kinds = [kind for kind in kinds_of(settings) if kind != "documents"]
    cube = _cube_for(kinds, silver, settings.where(F.col("report") != "documents"), as_of)
    found = []
    for kind in kinds:
        wanted = settings.where(F.col("report") == kind).select(*SETTING)
        rows, _ = _report_rows(kind, wanted, cube, routes)
        if kind == "airline":
            rows = rows.withColumnsRenamed(AGENT_AIRLINE_NAMES)
        names = {"risk": AGENT_ROUTE, "airline": AGENT_AIRLINE, "weather": WEATHER_NAMES}[kind]
        found.append(_as_text(rows, names, "primary").withColumn("report", F.lit(kind)))
    still_open = settings
    if found:
        first = materialise(reduce(DataFrame.unionByName, found), "facts")
        answered = first.where(F.col("fact_rank") == 1).select("report", *SETTING)
        still_open = materialise(_by_setting(settings, answered, "left_anti", ["report"]), "open")
        found = [first]
    wanted = still_open.select(*SETTING).distinct()
    pairs = setting_rag_facts(wanted, documents, as_of).withColumnsRenamed(AGENT_PAIR_NAMES)
    told = _as_text(pairs, AGENT_RAG, SOURCE_DOCUMENTS)
    rest = _by_setting(still_open, told, "inner").withColumn(
        "source", F.when(F.col("report") == "documents", "primary").otherwise(F.col("source"))
    )
    answers = reduce(DataFrame.unionByName, [*found, rest])
    return _by_setting(keyed, answers, "inner", ["report"]).select(
        "request_id", "fact_rank", "source", "fact_json", "fact_pairs"
    )


def kinds_of(settings: DataFrame) -> list[str]:
    """The different reports that are asked for, of the handful there are."""
    return sorted(row["report"] for row in settings.select("report").distinct().collect())


def _cube_for(
    kinds: list[str], silver: DataFrame, settings: DataFrame, as_of: dt.date
) -> DataFrame | None:
    """The stored flight cube, unless the risk report is the only one."""
    if not set(kinds) - {"risk"}:
        return None
    return materialise(flight_cube(silver, windows_of(settings), as_of), "cube")


def _report_rows(
    kind: str, settings: DataFrame, cube: DataFrame | None, routes: DataFrame
) -> tuple[DataFrame, list[str]]:
    if kind == "risk":
        return _route_setting_facts(settings, routes), ROUTE_NAMES
    if kind == "airline":
        return _airline_setting_facts(settings, cube), AIRLINE_NAMES
    if kind == "weather":
        return _weather_setting_facts(settings, cube), WEATHER_NAMES
    return _generic_setting_facts(settings, cube), GENERIC_NAMES


def _by_setting(rows: DataFrame, facts: DataFrame, how: str, also: list[str] = ()) -> DataFrame:
    """A join on the setting, absent filters being equal, and on the keys ``also`` given."""
    keys = [*SETTING, *also]
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in keys]
    joined = rows.alias("a").join(facts.alias("b"), same, how)
    if how == "left_anti":
        return joined
    return joined.select("a.*", *[f"b.{c}" for c in facts.columns if c not in keys])
