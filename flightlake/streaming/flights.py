"""Flight files to Silver, as a stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlake.operators.quality import clean_flights, dedup_flights
from flightlake.schemas import BRONZE, SILVER
from flightlake.session import materialise, stateful_session
from flightlake.sources.tables import available


def bronze_stream(spark: SparkSession, root: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(BRONZE)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(f"{root}/raw/date=*")
    )


def silver_stream(raw: DataFrame) -> DataFrame:
    """The Silver rules in a stream; no row is ever too late.

    The ids seen are keyed state without a time bound, so a micro-batch costs its
    own ids, however far apart two duplicates lie. Which of them survives depends
    on arrival, as in the arbitrary-survivor batch form.
    """
    return clean_flights(raw).dropDuplicates(["flight_id"])


def stream_bronze_to_silver(
    spark: SparkSession,
    root: str,
    silver_path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process every file that has landed, append to Silver's day folders, then stop.

    The state of ids is in RocksDB and its checkpoints, so it may exceed memory.
    """
    return (
        silver_stream(bronze_stream(stateful_session(spark), root, files_per_batch))
        .writeStream.format("parquet")
        .partitionBy("ingest_date")
        .option("path", silver_path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def open_seen_ids(spark: SparkSession, table: str, path: str, silver_path: str, buckets: int) -> None:
    """The index of ids a Silver folder holds: (flight_id, batch), hash-bucketed by id, below ``path``.

    A catalog that has lost the table finds the files again, with the same number
    of buckets; where no file is there yet, the ids Silver holds are indexed once.
    """
    columns = "flight_id string, batch bigint"
    indexed = available(spark, path) is not None
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"CLUSTERED BY (flight_id) SORTED BY (flight_id) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    silver = available(spark, silver_path)
    if silver is not None and not indexed:
        add_seen_ids(silver.select("flight_id", F.col("batch").cast("bigint")), table, buckets)


def add_seen_ids(ids: DataFrame, table: str, buckets: int) -> None:
    """Append ids, one sorted file per bucket; the shuffle hashes as the buckets do."""
    ids.repartition(buckets, "flight_id").sortWithinPartitions("flight_id").write.insertInto(table)


def unseen_flights(flights: DataFrame, seen: DataFrame, batch_id: int) -> DataFrame:
    """The flights whose ids no earlier micro-batch has brought.

    The ids are joined bucket by bucket where they lie, unless Spark finds them
    few enough to broadcast; only the flights of the micro-batch are shuffled.
    """
    earlier = seen.where(F.col("batch") < batch_id).select("flight_id")
    return flights.join(earlier, "flight_id", "left_anti")


def stream_silver_exact(
    spark: SparkSession,
    root: str,
    silver_path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    seen_table: str | None = None,
    buckets: int = 64,
) -> StreamingQuery:
    """The same job without state: ids are checked against an index of those in Silver.

    Each micro-batch is de-duplicated on its own, then loses the ids that an
    earlier one has already brought. Silver itself is never read: its ids are kept
    in ``seen_table``, hash-bucketed, below ``silver_path`` with ``_seen`` added.
    Batch n owns the folder ``batch=n``, its ids carry its number, and it ignores
    those of its own earlier attempt, so a rerun changes nothing. Every micro-batch
    adds a file per bucket; choose few buckets for many small ones.
    """
    table = seen_table or f"seen_{hashlib.sha256(silver_path.encode()).hexdigest()[:16]}"
    open_seen_ids(spark, table, f"{silver_path}_seen", silver_path, buckets)

    def add(rows: DataFrame, batch_id: int) -> None:
        session = rows.sparkSession
        own = materialise(dedup_flights(rows), "flights")
        fresh = materialise(unseen_flights(own, session.table(table), batch_id), "fresh")
        (
            fresh.select(*SILVER.fieldNames())
            .hint("rebalance", "ingest_date")
            .write.mode("overwrite")
            .partitionBy("ingest_date")
            .parquet(f"{silver_path}/batch={batch_id}")
        )
        numbered = fresh.select("flight_id", F.lit(batch_id).cast("bigint").alias("batch"))
        add_seen_ids(numbered, table, buckets)

    return (
        clean_flights(bronze_stream(spark, root, files_per_batch))
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
