"""Request log: filtered export and hourly token sums, as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flightlake.operators.logs import log_export_filter, token_usage_rows
from flightlake.schemas import RUN_LOG
from flightlake.session import stateful_session


def log_stream(
    spark: SparkSession,
    path: str,
    file_format: str = "json",
    files_per_batch: int = 1000,
    schema: T.StructType = RUN_LOG,
) -> DataFrame:
    """Log files as they arrive; with ``VARIANT_LOG`` the export keeps payloads as they were written."""
    return (
        stateful_session(spark)
        .readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .format(file_format)
        .load(path)
    )


def stream_run_log(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Exported events into day folders, exactly once."""
    return (
        log_export_filter(records)
        .writeStream.format("parquet")
        .partitionBy("log_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def hourly_tokens(records: DataFrame) -> DataFrame:
    """Token sums per hour and endpoint, so far: state is a row per hour and endpoint, and no event is late."""
    usage = token_usage_rows(records)
    return usage.groupBy("hour", "endpoint").agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("response_tokens").alias("response_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
    )


def stream_hourly_tokens(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the sums that change in each micro-batch to ``path/batch=N``, the open hours' too.

    A batch that runs again overwrites its own folder.
    """

    def save(sums: DataFrame, batch_id: int) -> None:
        sums.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        hourly_tokens(records)
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_hourly_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The newest sums of every hour and endpoint."""
    sums = ["prompt_tokens", "response_tokens", "total_tokens"]
    newest = F.max_by(F.struct(*sums), "batch").alias("sums")
    return (
        spark.read.parquet(path).groupBy("hour", "endpoint").agg(newest).select("hour", "endpoint", "sums.*")
    )


def keep_hourly_tokens(records: DataFrame, checkpoint: str) -> StreamingQuery:
    """Keep the sums in the stream's own state and write nothing else.

    The state holds a row per hour and endpoint, and its old versions are dropped
    while the stream runs, so their number doesn't grow with the micro-batches;
    only the source's own list of files read does. :func:`hourly_tokens_state`
    reads it.
    """
    return (
        hourly_tokens(records)
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def hourly_tokens_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The sums as of the last finished micro-batch of :func:`keep_hourly_tokens`."""
    # the state names all its sums alike, so they are named by place
    sums = "struct<prompt_tokens:bigint, response_tokens:bigint, total_tokens:bigint>"
    return (
        spark.read.format("statestore")
        .load(checkpoint)
        .select("key.hour", "key.endpoint", F.col("value").cast(sums).alias("sums"))
        .select("hour", "endpoint", "sums.*")
    )
