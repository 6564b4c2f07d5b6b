"""Silver rules: types, keys, ranges, rejects and quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.constants import (
    DELAY_MAX,
    DELAY_MIN,
    REQUIRED_FIELDS,
    SILVER_KEYS,
)
from flightlake.schemas import SILVER

SURVIVOR_ORDER = [
    "event_ts",
    "airline",
    "origin",
    "destination",
    "departure_delay_min",
    "arrival_delay_min",
    "status",
    "weather_flag",
]


def silver_typed(raw: DataFrame) -> DataFrame:
    """Cast the four typed columns; text that does not parse becomes NULL."""
    return raw.withColumns(
        {
            "departure_delay_min": F.col("departure_delay_min").try_cast("int"),
            "arrival_delay_min": F.col("arrival_delay_min").try_cast("int"),
            "weather_flag": F.col("weather_flag").try_cast("boolean"),
            "event_ts": F.col("event_ts").try_cast("timestamp"),
        }
    )


def ingest_date(typed: DataFrame) -> DataFrame:
    return typed.withColumn("ingest_date", F.to_date("event_ts"))


def has_keys() -> Column:
    present = F.lit(True)
    for name in SILVER_KEYS:
        present = present & F.col(name).isNotNull()
    return present


def delays_in_range() -> Column:
    """Both delays within bounds, bounds included; a NULL delay is not in range."""
    departure = F.col("departure_delay_min").between(DELAY_MIN, DELAY_MAX)
    arrival = F.col("arrival_delay_min").between(DELAY_MIN, DELAY_MAX)
    return F.coalesce(departure & arrival, F.lit(False))


def real_route() -> Column:
    return F.coalesce(F.col("origin") != F.col("destination"), F.lit(False))


def drop_missing_keys(typed: DataFrame) -> DataFrame:
    return typed.dropna(subset=SILVER_KEYS)


def delay_range(typed: DataFrame) -> DataFrame:
    return typed.where(delays_in_range())


def no_self_route(typed: DataFrame) -> DataFrame:
    return typed.where(real_route())


def dedup_flights(flights: DataFrame, any_survivor: bool = False) -> DataFrame:
    """One row per flight id: the first in a total order, so reruns agree.

    The rank filter is applied once per map task before the shuffle, so a
    flight id with a third of all rows sends one row per task. With
    ``any_survivor`` the cheaper, non-deterministic built-in is used.
    """
    if any_survivor:
        return flights.dropDuplicates(["flight_id"])
    order = [F.col(name).asc_nulls_first() for name in SURVIVOR_ORDER]
    first = Window.partitionBy("flight_id").orderBy(*order)
    return (
        flights.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def clean_flights(raw: DataFrame) -> DataFrame:
    """Typed rows that pass every rule, duplicates still in; stateless, so it also streams."""
    return (
        ingest_date(silver_typed(raw))
        .transform(drop_missing_keys)
        .transform(delay_range)
        .transform(no_self_route)
        .select(*SILVER.fieldNames())
    )


def silver_flights(raw: DataFrame, any_survivor: bool = False) -> DataFrame:
    """The whole Silver job: raw text rows to clean, unique flights."""
    return dedup_flights(clean_flights(raw), any_survivor)


def is_missing(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def reject_reason() -> Column:
    """Why a raw record cannot become a document; NULL when it can.

    Missing fields are named first, in field order, then values that do not parse.
    """
    reason = F.lit(None).cast("string")
    unreadable = [
        ("departure_delay_min", "int"),
        ("arrival_delay_min", "int"),
        ("event_ts", "timestamp"),
    ]
    for name, kind in reversed(unreadable):
        bad = F.col(name).try_cast(kind).isNull()
        reason = F.when(bad, f"invalid value: {name}").otherwise(reason)
    for name in reversed(REQUIRED_FIELDS):
        reason = F.when(is_missing(name), f"missing required field: {name}").otherwise(reason)
    return reason


def with_reject_reason(raw: DataFrame) -> DataFrame:
    return raw.withColumn("reject_reason", reject_reason())


def valid_records(raw: DataFrame) -> DataFrame:
    return raw.where(reject_reason().isNull())


def rejected_records(raw: DataFrame) -> DataFrame:
    return with_reject_reason(raw).where(F.col("reject_reason").isNotNull())


def bad_row_metrics(raw: DataFrame) -> DataFrame:
    """Rows kept and skipped, by reason; kept rows carry a NULL reason."""
    return with_reject_reason(raw).groupBy("reject_reason").agg(F.count("*").alias("records"))


def quality_metrics(raw: DataFrame) -> DataFrame:
    """Raw, clean and dropped counts in one pass over the raw rows.

    The clean count is the number of distinct flight ids among passing rows,
    so no second evaluation of the cleaned frame is needed.
    """
    typed = ingest_date(silver_typed(raw))
    keyed = has_keys()
    ranged = keyed & delays_in_range()
    passed = ranged & real_route()
    counts = typed.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(~keyed).alias("missing_keys"),
        F.count_if(keyed & ~delays_in_range()).alias("out_of_range"),
        F.count_if(ranged & ~real_route()).alias("self_routes"),
        F.count_if(passed).alias("passing_rows"),
        F.count_distinct(F.when(passed, F.col("flight_id"))).alias("clean_rows"),
    )
    dropped = F.col("raw_rows") - F.col("clean_rows")
    return counts.select(
        "raw_rows",
        "missing_keys",
        "out_of_range",
        "self_routes",
        (F.col("passing_rows") - F.col("clean_rows")).alias("duplicates"),
        "clean_rows",
        dropped.alias("dropped_rows"),
        F.coalesce(
            F.try_divide(dropped.cast("double") * F.lit(100.0), F.col("raw_rows")), F.lit(0.0)
        ).alias("dropped_pct"),
    )
