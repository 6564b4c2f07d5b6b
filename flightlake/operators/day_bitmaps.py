"""Totals of any window from what is stored per day, exact distinct counts included.

Distinct counts don't add up over days, sets do: each day keeps a bitmap of the
numbers its airlines and routes have, and a window is the union of its days'.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.facts import days_back_filter
from flightlake.operators.gold import with_route
from flightlake.session import materialise

KINDS = ["airline", "route"]


def _named(silver: DataFrame) -> DataFrame:
    """(ingest_date, kind, name): the airlines and routes of each day."""
    names = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("name")) for k in KINDS])
    named = with_route(silver).select("ingest_date", F.inline(names))
    return named.where(F.col("name").isNotNull()).distinct()


def number_names(silver: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(kind, name, number): the ``known`` numbers and, above them, one for each name that has none.

    Numbers are unique and dense within a partition; no task sees all names. The
    result is stored, so the numbers stay.
    """
    names = _named(silver).select("kind", "name").distinct()
    if known is None:
        return materialise(names.withColumn("number", F.monotonically_increasing_id()), "names")
    highest = known.agg(F.coalesce(F.max("number"), F.lit(-1))).scalar()
    new = names.join(known, ["kind", "name"], "left_anti")
    new = new.withColumn("number", F.monotonically_increasing_id() + highest + 1)
    return materialise(known.unionByName(new), "names")


def day_bitmaps(silver: DataFrame, names: DataFrame) -> DataFrame:
    """(ingest_date, kind, bucket, bits): the numbers that occur on a day, 32,768 to a bitmap."""
    numbered = _named(silver).join(names, ["kind", "name"])
    return numbered.groupBy(
        "ingest_date", "kind", F.bitmap_bucket_number("number").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def day_sums(silver: DataFrame) -> DataFrame:
    """(ingest_date, flights, delay_total, delay_known): what adds up over days."""
    return silver.groupBy("ingest_date").agg(
        F.count("*").alias("flights"),
        F.sum("departure_delay_min").alias("delay_total"),
        F.count("departure_delay_min").alias("delay_known"),
    )


def window_totals(
    sums: DataFrame, bitmaps: DataFrame, as_of: dt.date, days_back: int
) -> DataFrame:
    """The general report of a window from stored days; no flight is read. One row, always."""
    united = (
        days_back_filter(bitmaps, "ingest_date", as_of, days_back)
        .groupBy("kind", "bucket")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    held = F.bitmap_count("bits")
    counts = united.select(
        *[F.when(F.col("kind") == k, held).otherwise(0).alias(f"{k}_count") for k in KINDS]
    )
    added = days_back_filter(sums, "ingest_date", as_of, days_back).drop("ingest_date")
    parts = added.unionByName(counts, allowMissingColumns=True)

    def total(name: str):
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    delay = F.try_divide(F.sum("delay_total").cast("double"), F.sum("delay_known"))
    return parts.agg(
        total("flights").alias("total_flights"),
        *[total(f"{k}_count").alias(f"{k}_count") for k in KINDS],
        F.round(delay, 1).alias("avg_delay_minutes"),
    )
