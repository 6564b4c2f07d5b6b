"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("flightlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of its own for a stream with state: state may exceed memory, idle streams stop.

    Its settings reach no other query. Time zone and shuffle partitions are the
    caller's.
    """
    own = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
        own.conf.set(name, spark.conf.get(name))
    own.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    # versions of the state that a restart may go back to; older files are dropped as the stream runs
    own.conf.set("spark.sql.streaming.minBatchesToRetain", "10")
    own.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "5s")
    return own


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for staged files, below the cluster's shared checkpoint folder.

    Only a local master may fall back to a temporary folder; anywhere else the
    executors would not see it, so the setting is demanded.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="flightlake-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialise(rows: DataFrame, purpose: str) -> DataFrame:
    """Write rows once to the shared folder and read them back.

    For results that several branches of a job need: they are computed one
    time, their size is known to the planner, and a lost executor costs nothing.
    """
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
