"""Named queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``build(spark, sf_dir)`` under a name, with its SQL where there is one."""

    def add(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return zoneless(build(spark, sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values, the form the SQL side has."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})
