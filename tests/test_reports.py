import datetime as dt

import pytest
from pyspark.sql import functions as F

from flightlake.operators import day_bitmaps, facts, gold, views
from flightlake.schemas import SILVER

DAY = dt.date(2024, 1, 20)
AS_OF = dt.date(2024, 1, 21)


def row(n, airline="AA", route="ATL-LAX", dep=10, arr=10, weather=False, status="ON_TIME", day=DAY):
    origin, destination = route.split("-")
    ts = dt.datetime.combine(day, dt.time(12)) if day else None
    return (f"F{n}", airline, origin, destination, dep, arr, weather, status, ts, day)


def silver(spark, *rows):
    return spark.createDataFrame(list(rows), SILVER)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_gold_in_one_scan_equals_the_union(spark):
    rows = [
        row(1, "AA", status="DELAYED", weather=True),
        row(2, "AA", dep=25, status="DELAYED", day=dt.date(2024, 1, 19)),
        row(3, "UA", "LAX-ATL", dep=None, arr=None),
        row(4, "UA", "LAX-ATL", dep=None, arr=None, weather=None, day=dt.date(2024, 1, 18)),
    ]
    frame = silver(spark, *rows)
    once = gold.gold_summary(frame).drop("generated_ts")
    assert as_set(once) == as_set(gold.gold_union(frame))
    days = once.where("summary_type = 'delayed_by_day'")
    assert {r["dimension_key"] for r in days.collect()} == {"2024-01-20", "2024-01-19"}


def test_gold_of_nothing_is_empty(spark):
    assert gold.gold_summary(silver(spark)).count() == 0
    status = views.gold_refresh(gold.gold_summary(silver(spark))).collect()[0]
    assert status["gold_summary_rows"] == 0


def test_driver_takes_the_first_rule(spark):
    rows = [
        row(1, weather=True, dep=100),
        row(2, dep=60, arr=90),
        row(3, dep=59, arr=60),
        row(4, status="CANCELLED"),
        row(5, status="DIVERTED"),
        row(6, weather=None, dep=None, arr=None, status=None),
    ]
    found = views.delay_explanations(silver(spark, *rows)).orderBy("flight_id").collect()
    assert [r["primary_delay_driver"] for r in found] == [
        "WEATHER", "SEVERE_DEP_DELAY", "SEVERE_ARR_DELAY", "CANCELLATION", "DIVERSION",
        "OPERATIONAL",
    ]


def test_risk_score_weights(spark):
    rows = [row(1, dep=90, status="DELAYED", weather=True), row(2), row(3), row(4)]
    risk = views.route_risk(silver(spark, *rows)).collect()[0]
    assert risk["risk_score"] == 25.0
    assert (risk["disruption_rate"], risk["severe_delay_rate"]) == (0.25, 0.25)


def test_narrative_numbers_have_no_trailing_zeros(spark):
    rows = [row(1, dep=12, status="DELAYED"), row(2, dep=13)]
    frame = silver(spark, *rows)
    airlines = views.bi_airline_performance(gold.gold_summary(frame))
    texts = {r["fact_type"]: r for r in views.nl_facts(views.route_risk(frame), airlines).collect()}
    assert texts["airline_performance"]["narrative_text"] == (
        "Airline AA average departure delay is 12.5 minutes across 2 flights."
    )
    assert texts["route_risk"]["narrative_text"] == (
        "Route ATL-LAX risk score is 22.5 with disruption rate 50% and weather impact 0%."
    )
    assert '"generated_ts"' in texts["airline_performance"]["fact_payload"]


def test_payload_keeps_null_fields(spark):
    frame = silver(spark, row(1, dep=None, arr=None))
    routes = views.route_risk(frame)
    airlines = views.bi_airline_performance(gold.gold_summary(frame))
    payload = views.nl_facts(routes, airlines).where("fact_type = 'route_risk'").collect()[0]
    assert '"avg_departure_delay_min":null' in payload["fact_payload"]


# --- facts ---


def documents(spark, *rows):
    schema = "doc_id string, airline string, route string, event_date date, metadata string"
    return spark.createDataFrame(list(rows), schema)


def doc(n, airline="AA", route="ATL-LAX", day=DAY, metadata=None):
    text = metadata or '{"status":"DELAYED","weather_flag":true,"departure_delay_min":30}'
    return (f"D{n}", airline, route, day, text)


@pytest.mark.parametrize("given, service, tool", [(0, 7, 1), (-3, 7, 1), (5, 5, 5), (99, 99, 30)])
def test_days_back_rules(given, service, tool):
    assert facts.service_days_back(given) == service
    assert facts.tool_days_back(given) == tool


def test_window_includes_its_first_day(spark):
    docs = documents(spark, doc(1, day=dt.date(2024, 1, 14)), doc(2, day=dt.date(2024, 1, 13)))
    assert facts.rag_facts(docs, AS_OF, 7).collect()[0]["flight_count"] == 1


def test_weather_means_skip_documents_without_the_flag(spark):
    docs = documents(
        spark,
        doc(1),
        doc(2, metadata='{"weather_flag":false,"departure_delay_min":10}'),
        doc(3, metadata='{"departure_delay_min":1000}'),
        doc(4, metadata="not json"),
    )
    found = facts.weather_impact(docs, AS_OF).collect()[0]
    assert found["total_flights"] == 4
    assert (found["avg_delay_if_weather"], found["avg_delay_if_not_weather"]) == (30.0, 10.0)
    assert found["weather_pct"] == 25.0


def test_ties_are_broken_by_key(spark):
    docs = documents(spark, *[doc(n, airline=a) for n, a in enumerate("ZYXWVUTSRQPO")])
    top = [r["airline"] for r in facts.rag_facts(docs, AS_OF).collect()]
    assert top == sorted("ZYXWVUTSRQPO")[:10]


def test_service_prefers_documents_then_the_report(spark):
    flights = silver(spark, row(1, dep=40), row(2, "UA"))
    routes = views.route_risk(flights)
    docs = documents(spark, doc(1))

    def ask(kind, documents=docs, **more):
        return facts.service_facts(kind, documents, flights, routes, AS_OF, **more).collect()

    assert {r["source"] for r in ask("weather")} == {"ai_rag_documents"}
    assert "avg_risk_score" in ask("Disruption", airline="ZZ")[0].asDict()
    assert ask("delays", airline="UA")[0]["airline"] == "UA"
    assert ask("impact", documents=None)[0]["weather_affected"] == 0
    assert ask("anything", route="XXX-YYY")[0]["airline_count"] == 2


def test_agent_prefers_the_report_then_documents(spark):
    flights = silver(spark, row(1, dep=40))
    routes, docs = views.route_risk(flights), documents(spark, doc(1))

    def source(kind, silver_rows=flights, route_rows=routes, **more):
        found = facts.query_analytics(kind, docs, silver_rows, route_rows, AS_OF, **more)
        return [r["source"] for r in found.collect()]

    assert source("route_risk", route="atl-lax") == ["primary"]
    assert source("route_risk", route="xxx-yyy") == []
    assert source("risk", route_rows=None) == ["ai_rag_documents"]
    assert source("airline", airline="aa") == ["primary"]
    assert source("delays", silver_rows=None) == ["ai_rag_documents"]
    assert source("weather", airline="aa") == ["primary"]
    assert source("generic") == ["primary"]


def test_status_falls_back_while_gold_is_missing(spark):
    docs = documents(spark, doc(1))
    assert facts.freshness_status(None, docs).collect()[0]["source"] == "ai_rag_documents"
    empty = gold.gold_summary(silver(spark))
    short = facts.freshness_status(empty, docs, brief=True)
    assert "earliest_ingest_date" not in short.columns
    full = gold.gold_summary(silver(spark, row(1)))
    assert "on_time_rows" not in facts.freshness_status(full, docs, brief=True).columns


@pytest.mark.parametrize(
    "delay, weather, expected",
    [(100.0, 30.0, "monitor_weather"), (60.1, 29.9, "escalate_ops"), (60.0, 0.0, "no_action")],
)
def test_decisions(spark, delay, weather, expected):
    rows = spark.createDataFrame([(delay, weather)], "avg_delay_min double, weather_pct double")
    assert facts.mitigation_decision(rows).collect()[0]["decision"] == expected


def test_metadata_values_are_read_as_text(spark):
    measures = facts.document_measures(documents(spark, doc(1), doc(2, metadata="{"))).collect()
    found = {(m["delay_min"], m["weather_text"], m["status"]) for m in measures}
    assert found == {(30.0, "true", "DELAYED"), (None, None, None)}


def test_windows_from_stored_days_equal_the_report(spark):
    """Names that are new on a later day get numbers of their own; null airlines count as none."""
    days = [dt.date(2024, 1, day) for day in (1, 1, 2, 3, 3)]
    airlines = ["AA", None, "DL", "AA", "UA"]
    rows = [
        (f"F{n}", airline, "ATL", f"X{n % 3}", 10 * n, 5, False, "ON_TIME", str(day), day)
        for n, (airline, day) in enumerate(zip(airlines, days, strict=True))
    ]
    silver = spark.createDataFrame(rows, [f.name for f in SILVER]).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SILVER]
    )
    names, bitmaps = None, []
    for day in sorted(set(days)):
        part = silver.where(F.col("ingest_date") == day)
        names = day_bitmaps.number_names(part, names)
        bitmaps.append(day_bitmaps.day_bitmaps(part, names))
    assert names.count() == names.select("number").distinct().count() == 6
    stored = bitmaps[0].unionByName(bitmaps[1]).unionByName(bitmaps[2])
    sums = day_bitmaps.day_sums(silver)
    for as_of, back in ((days[-1], 0), (days[-1], 1), (days[-1], 30), (dt.date(2025, 1, 1), 1)):
        found = day_bitmaps.window_totals(sums, stored, as_of, back).collect()
        assert found == facts.generic_facts(silver, as_of, back).collect()
