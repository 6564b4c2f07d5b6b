"""Gold from stored day sums: what a refresh sums anew, and that it equals Gold made at once."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from flightlake.operators import gold
from flightlake.plans.daily_gold import refresh_gold
from flightlake.plans.sql_tools import register_tools
from flightlake.plans.warehouse import Warehouse
from flightlake.sources.tables import write_silver
from tests.test_reports import row, silver

NOW = dt.datetime(2024, 2, 1)
DAYS = [dt.date(2024, 1, d) for d in (18, 19, 20)]


def flights(spark, days, dep=10):
    rows = []
    for i, day in enumerate(days):
        rows += [
            row(f"{day}-1", "AA", dep=dep + i, status="DELAYED", weather=True, day=day),
            row(f"{day}-2", "UA", "LAX-ATL", dep=None, arr=-3, day=day),
            row(f"{day}-3", "UA", "LAX-ATL", dep=7, arr=None, weather=None, day=day),
        ]
    return silver(spark, *rows)


def as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.fixture
def refresh(spark):
    name = f"g{uuid.uuid4().hex}"

    def run():
        days = refresh_gold(spark, f"{name}_silver", f"{name}_sums", f"{name}_gold", NOW)
        assert as_set(spark.table(f"{name}_gold")) == as_set(gold.gold_summary(spark.table(f"{name}_silver"), NOW))
        return days

    return f"{name}_silver", run


def append(rows, table):
    rows.write.mode("append").format("parquet").partitionBy("ingest_date").saveAsTable(table)


def test_only_changed_days_are_summed(spark, refresh):
    table, run = refresh
    write_silver(flights(spark, DAYS[:2]), table)
    assert run() == DAYS[:2]
    assert run() == []
    append(flights(spark, DAYS[2:]), table)
    assert run() == DAYS[2:]
    append(flights(spark, DAYS[:1], dep=99), table)
    assert run() == DAYS[:1]
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (ingest_date = DATE '{DAYS[1]}')")
    assert run() == []
    assert spark.table(table).select("ingest_date").distinct().count() == 2


def test_a_refresh_that_breaks_off_is_made_up_for(spark, refresh, monkeypatch):
    table, run = refresh
    write_silver(flights(spark, DAYS), table)
    with monkeypatch.context() as patch:
        patch.setattr("flightlake.plans.daily_gold.write_gold", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run()
    assert run() == DAYS
    assert run() == []


def test_an_empty_silver_has_no_gold_rows(spark, refresh):
    table, run = refresh
    write_silver(flights(spark, DAYS[:1]), table)
    assert run() == DAYS[:1]
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (ingest_date = DATE '{DAYS[0]}')")
    assert run() == []
    assert spark.table(table).isEmpty()


def test_sums_read_only_the_changed_days(spark, refresh):
    table, run = refresh
    write_silver(flights(spark, DAYS), table)
    days = spark.table(table).where(F.col("ingest_date").isin(DAYS[:1]))
    text = gold.day_sums(days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in text or "PartitionFilters: [ingest_date" in text


def test_sql_tools_bind_their_arguments(spark):
    frame = flights(spark, DAYS)
    documents = spark.createDataFrame(
        [("d1", "AA", "ATL-LAX", DAYS[0], '{"departure_delay_min": 5, "weather_flag": true, "status": "DELAYED"}')],
        "doc_id string, airline string, route string, event_date date, metadata string",
    )
    lake = Warehouse(spark, documents, dt.date(2024, 1, 21), frame, gold.gold_summary(frame, NOW))
    assert "query_facts" in register_tools(lake)
    found = spark.sql("SELECT * FROM detect_delay_risk(airline => :a)", args={"a": "aa"}).collect()
    assert [(r["airline"], r["avg_delay_min"], r["weather_pct"]) for r in found] == [("AA", 5.0, 100.0)]
    assert spark.sql("SELECT * FROM detect_delay_risk(:a)", args={"a": "x' OR '1'='1"}).isEmpty()
    many = spark.sql("SELECT t.days, f.flight_count FROM VALUES (1), (30) AS t(days), LATERAL detect_delay_risk(days_back => t.days) f")
    assert [tuple(r) for r in many.collect()] == [(30, 1)]
