"""Catalog tables and external Parquet folders."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from flightlake.schemas import SILVER


def write_silver(silver: DataFrame, table: str, path: str | None = None) -> None:
    """Replace the Silver table, one folder per ingest day.

    The rebalance hint gives files of even size: small days share a task and a
    hot day is split, instead of one writer per day.
    """
    writer = (
        silver.hint("rebalance", "ingest_date")
        .write.mode("overwrite")
        .format("parquet")
        .partitionBy("ingest_date")
    )
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_gold(gold: DataFrame, table: str, path: str | None = None) -> None:
    """Replace the Gold table, unpartitioned: it holds one row per airline, route and day."""
    writer = gold.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def export_flat(spark: SparkSession, table: str, path: str) -> None:
    """Copy a table to plain Parquet files; the partition column stays in the data."""
    spark.table(table).write.mode("overwrite").parquet(path)


def silver_ext(spark: SparkSession, path: str) -> DataFrame:
    """Exported Silver under its declared schema, without inference."""
    return spark.read.schema(SILVER).parquet(path)


def gold_ext(spark: SparkSession, path: str) -> DataFrame:
    """Exported Gold, schema taken from the files."""
    return spark.read.parquet(path)


def available(spark: SparkSession, path: str) -> DataFrame | None:
    """A Parquet folder, or None where it does not exist yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
