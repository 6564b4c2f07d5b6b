"""Raw flight files: header CSV, one folder per landing day, every column text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.constants import FLIGHT_FIELDS
from flightlake.schemas import BRONZE, SAMPLE


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """All landed days. The day folder is not a column, as Silver derives its own."""
    return (
        spark.read.schema(BRONZE)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(f"{root}/raw/date=*/*.csv")
    )


def write_bronze(flights: DataFrame, root: str, day: str = "date") -> None:
    """Land rows below ``raw/date=D``, replacing the days they belong to.

    Rebalancing splits a hot day over several files.
    """
    (
        flights.select(*FLIGHT_FIELDS, F.col(day).alias("date"))
        .hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .option("header", True)
        .csv(f"{root}/raw")
    )


def read_sample(spark: SparkSession, path: str) -> DataFrame:
    """The second flight layout: scheduled times, aircraft and passengers."""
    return (
        spark.read.schema(SAMPLE)
        .option("header", True)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .csv(path)
    )
