import pytest
from pyspark.sql import functions as F

from flightlake.constants import FLIGHT_FIELDS
from flightlake.operators import quality
from flightlake.schemas import BRONZE, SILVER

GOOD = ["F1", "AA", "ATL", "LAX", "10", "20", "TRUE", "DELAYED", "2024-01-05T10:00:00+00:00"]


def flight(**changes):
    return tuple(changes.get(name, value) for name, value in zip(FLIGHT_FIELDS, GOOD))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), BRONZE)


@pytest.mark.parametrize(
    "changes, kept",
    [
        ({}, True),
        ({"departure_delay_min": "-60"}, True),
        ({"departure_delay_min": "-61"}, False),
        ({"arrival_delay_min": "600"}, True),
        ({"arrival_delay_min": "601"}, False),
        ({"departure_delay_min": None}, False),
        ({"arrival_delay_min": "soon"}, False),
        ({"destination": "ATL"}, False),
        ({"airline": None}, False),
        ({"flight_id": None}, False),
        ({"event_ts": "yesterday"}, False),
        ({"weather_flag": "maybe"}, True),
        ({"status": None}, True),
    ],
)
def test_silver_rules(spark, changes, kept):
    assert quality.silver_flights(frame(spark, flight(**changes))).count() == int(kept)


def test_silver_types_and_day(spark):
    silver = quality.silver_flights(frame(spark, flight()))
    assert silver.schema.fieldNames() == SILVER.fieldNames()
    assert [f.dataType for f in silver.schema] == [f.dataType for f in SILVER]
    assert str(silver.collect()[0]["ingest_date"]) == "2024-01-05"


def test_empty_input(spark):
    empty = frame(spark)
    assert quality.silver_flights(empty).count() == 0
    metrics = quality.quality_metrics(empty).collect()[0]
    assert (metrics["raw_rows"], metrics["dropped_pct"]) == (0, 0.0)


def test_duplicates_keep_the_first_in_a_total_order(spark):
    rows = [
        flight(event_ts="2024-01-05T12:00:00+00:00", airline="AA"),
        flight(event_ts="2024-01-05T10:00:00+00:00", airline="UA"),
        flight(event_ts="2024-01-05T10:00:00+00:00", airline="DL"),
    ]
    for order in (rows, rows[::-1]):
        kept = quality.silver_flights(frame(spark, *order).repartition(3)).collect()
        assert [row["airline"] for row in kept] == ["DL"]


def test_a_hot_flight_id_is_cut_before_the_shuffle(spark):
    hot = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("F"), "id")).alias("flight_id"),
        *[F.lit(value).alias(name) for name, value in list(zip(FLIGHT_FIELDS, GOOD))[1:]],
    )
    result = quality.silver_flights(hot.repartition(4))
    assert result.count() == 2001
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_reject_reasons_name_the_first_fault(spark):
    rows = [
        flight(flight_id="", airline=None),
        flight(airline=""),
        flight(event_ts=None, departure_delay_min="x"),
        flight(weather_flag=""),
        flight(departure_delay_min="x", arrival_delay_min="y"),
        flight(event_ts="later"),
        flight(),
    ]
    reasons = [r["reject_reason"] for r in quality.with_reject_reason(frame(spark, *rows)).collect()]
    assert reasons == [
        "missing required field: flight_id",
        "missing required field: airline",
        "missing required field: event_ts",
        "missing required field: weather_flag",
        "invalid value: departure_delay_min",
        "invalid value: event_ts",
        None,
    ]


def test_quality_metrics_add_up(spark):
    rows = [flight(), flight(), flight(airline=None), flight(destination="ATL"),
            flight(arrival_delay_min="999"), flight(flight_id="F2")]
    m = quality.quality_metrics(frame(spark, *rows)).collect()[0].asDict()
    assert m == {
        "raw_rows": 6, "missing_keys": 1, "out_of_range": 1, "self_routes": 1, "duplicates": 1,
        "clean_rows": 2, "dropped_rows": 4, "dropped_pct": 400.0 / 6,
    }
