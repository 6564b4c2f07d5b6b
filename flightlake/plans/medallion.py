"""Batch jobs: raw files to Silver, Silver to Gold, tables to files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.gold import gold_summary
from flightlake.operators.quality import silver_flights
from flightlake.operators.views import route_risk
from flightlake.operators.facts import route_risk_facts
from flightlake.sources.bronze import read_bronze
from flightlake.sources.tables import export_flat, write_gold, write_silver


def bronze_to_silver(
    spark: SparkSession, root: str, table: str, path: str | None = None
) -> dict[str, float]:
    """Clean all raw files into the Silver table and report what was dropped.

    Both counts are observed while the table is written, so the files are read once.
    """
    raw_seen, clean_seen = Observation("raw"), Observation("clean")
    raw = read_bronze(spark, root).observe(raw_seen, F.count(F.lit(1)).alias("rows"))
    silver = silver_flights(raw).observe(clean_seen, F.count(F.lit(1)).alias("rows"))
    write_silver(silver, table, path)
    raw_rows, clean_rows = raw_seen.get["rows"], clean_seen.get["rows"]
    dropped = raw_rows - clean_rows
    return {
        "raw_rows": raw_rows,
        "clean_rows": clean_rows,
        "dropped_rows": dropped,
        "dropped_pct": 100.0 * dropped / raw_rows if raw_rows else 0.0,
    }


def silver_to_gold(
    spark: SparkSession,
    silver_table: str,
    gold_table: str,
    path: str | None = None,
    now: dt.datetime | None = None,
) -> None:
    write_gold(gold_summary(spark.table(silver_table), now), gold_table, path)


def export_tables(spark: SparkSession, exports: dict[str, str]) -> None:
    """Copy each table to its folder of plain Parquet files."""
    for table, path in exports.items():
        export_flat(spark, table, path)


def riskiest_routes(raw: DataFrame) -> DataFrame:
    """Raw flights to the ten riskiest routes, in one plan."""
    return route_risk_facts(route_risk(silver_flights(raw)))
