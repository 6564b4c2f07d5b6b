"""Gold kept up to date by day: sums per day are stored, and only changed days of Silver are read again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.gold import day_sums, gold_from_sums
from flightlake.session import materialise
from flightlake.sources.tables import write_gold


def day_stamps(silver: DataFrame) -> DataFrame:
    """(ingest_date, stamp): a digest of the names, sizes and times of each day's files.

    Only file metadata is asked for, so the scan reads footers, not columns.
    """
    told = silver.select(
        "ingest_date",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
    )
    files = told.distinct()
    return files.groupBy("ingest_date").agg(F.bit_xor(F.xxhash64("path", "size", "changed")).alias("stamp"))


def changed_days(spark: SparkSession, stamps: DataFrame, table: str) -> tuple[list[dt.date], list[dt.date]]:
    """(new or changed days, days that are gone) since ``table`` was written; one date per day at most."""
    if not spark.catalog.tableExists(table):
        return sorted(r["ingest_date"] for r in stamps.select("ingest_date").collect()), []
    before = spark.table(table).select("ingest_date", F.col("stamp").alias("before"))
    told = stamps.join(before, "ingest_date", "full").where("NOT (stamp <=> before)").collect()
    return (
        sorted(r["ingest_date"] for r in told if r["stamp"] is not None),
        sorted(r["ingest_date"] for r in told if r["stamp"] is None),
    )


def replace_days(spark: SparkSession, rows: DataFrame, table: str) -> None:
    """Overwrite the days that ``rows`` has and leave the others; tables heed the session's mode only."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(name, before)


def refresh_gold(
    spark: SparkSession,
    silver_table: str,
    sums_table: str,
    gold_table: str,
    now: dt.datetime | None = None,
) -> list[dt.date]:
    """Bring Gold up to date and return the days that were summed anew.

    Day folders of Silver whose files have changed are summed and replace their
    day in ``sums_table``; days that are gone are dropped. What the days were summed
    from is noted last (``sums_table``_stamps), so a refresh that breaks off
    sums them again. Gold is then made from the sums alone.
    """
    stamps = materialise(day_stamps(spark.table(silver_table)), "stamps")
    changed, gone = changed_days(spark, stamps, f"{sums_table}_stamps")
    if changed:
        days = spark.table(silver_table).where(F.col("ingest_date").isin(changed))
        sums = day_sums(days).hint("rebalance", "ingest_date")
        if spark.catalog.tableExists(sums_table):
            replace_days(spark, sums, sums_table)
        else:
            sums.write.format("parquet").partitionBy("ingest_date").saveAsTable(sums_table)
    for day in gone:
        spark.sql(f"ALTER TABLE {sums_table} DROP IF EXISTS PARTITION (ingest_date = DATE '{day}')")
    if spark.catalog.tableExists(sums_table):
        write_gold(gold_from_sums(spark.table(sums_table), now), gold_table)
    stamps.write.mode("overwrite").format("parquet").saveAsTable(f"{sums_table}_stamps")
    return changed
