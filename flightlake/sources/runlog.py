"""Structured request log: one row per event, one folder per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.constants import LOG_RETENTION_DAYS
from flightlake.functions.times import retained_from
from flightlake.schemas import LOG_PAYLOAD, RUN_LOG, VARIANT_LOG

# JSON writers cut timestamps to milliseconds unless told otherwise
MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def log_records(rows: DataFrame) -> DataFrame:
    """Flat event rows (``log_ts``, ``severity``, payload fields) as log records."""
    present = set(rows.columns)
    payload = [
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in LOG_PAYLOAD
    ]
    return rows.select(
        F.col("log_ts").cast("timestamp").alias("timestamp"),
        F.coalesce("severity", F.lit("INFO")).alias("severity"),
        F.struct(*payload).alias("jsonPayload"),
        F.to_date("log_ts").alias("log_date"),
    )


def variant_records(rows: DataFrame) -> DataFrame:
    """Flat event rows as log records whose payload holds every further column, known or not.

    A null field is left out of the payload, as the service's own logger does.
    """
    free = [c for c in rows.columns if c not in ("log_ts", "severity")]
    return rows.select(
        F.col("log_ts").cast("timestamp").alias("timestamp"),
        F.coalesce("severity", F.lit("INFO")).alias("severity"),
        F.parse_json(F.to_json(F.struct(*free), {"timestampFormat": MICROSECONDS})).alias("jsonPayload"),
        F.to_date("log_ts").alias("log_date"),
    )


def write_run_log(records: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Append log records; a hot day is split over several files."""
    (
        records.hint("rebalance", "log_date")
        .write.mode("append")
        .format(file_format)
        .option("timestampFormat", MICROSECONDS)
        .partitionBy("log_date")
        .save(path)
    )


def read_run_log(
    spark: SparkSession,
    path: str,
    now: dt.datetime,
    days: int = LOG_RETENTION_DAYS,
    file_format: str = "parquet",
    schema: T.StructType = RUN_LOG,
) -> DataFrame:
    """Log rows of the last days; the literal date cutoff prunes day folders.

    With ``VARIANT_LOG`` the payload is a variant: a field that is missing or can't
    be read as its type is null in the reports, and fields that no report knows stay.
    """
    records = spark.read.schema(schema).format(file_format).load(path)
    return records.where(F.col("log_date") >= F.lit(retained_from(now, days)))
