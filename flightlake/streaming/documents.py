"""Document batches upserted as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from flightlake.schemas import RAG_DOCUMENTS
from flightlake.sources.document_table import FANOUT, compact_table, upsert_table


def document_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(RAG_DOCUMENTS)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def stream_upsert_docs(
    batches: DataFrame, table: str, checkpoint: str, most_versions: int = FANOUT
) -> StreamingQuery:
    """Merge each micro-batch into the table, a level of which is compacted when it has ``most_versions``.

    Merging the same batch twice gives the same table, so a batch that runs
    again after a failure does no harm and leaves no id twice.
    """

    def merge(rows: DataFrame, batch_id: int) -> None:
        upsert_table(rows.sparkSession, table, rows)
        compact_table(rows.sparkSession, table, most_versions)

    return (
        batches.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
