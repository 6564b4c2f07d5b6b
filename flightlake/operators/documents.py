"""Retrieval documents: build, de-duplicate, upsert, pair with vectors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.constants import SOURCE_TYPE
from flightlake.operators.quality import valid_records


def _python_bool(flag: Column) -> Column:
    return F.initcap(flag.cast("string"))


def rag_documents(records: DataFrame, updated_ts: Column | None = None) -> DataFrame:
    """One document per complete raw record: a sentence, filters and JSON metadata.

    ``updated_ts`` may be any expression over the record, such as the clock.
    """
    stamp = [] if updated_ts is None else [updated_ts.alias("updated_ts")]
    flights = valid_records(records).select(
        "flight_id",
        "airline",
        F.concat("origin", F.lit("-"), "destination").alias("route"),
        F.col("departure_delay_min").try_cast("int").alias("departure_delay_min"),
        F.col("arrival_delay_min").try_cast("int").alias("arrival_delay_min"),
        "status",
        (F.col("weather_flag") == "TRUE").alias("weather_flag"),
        F.col("event_ts").cast("string").alias("event_ts"),
        *stamp,
    )
    sentence = F.concat(
        F.lit("Flight "), F.col("flight_id"),
        F.lit(" for airline "), F.col("airline"),
        F.lit(" on route "), F.col("route"),
        F.lit(" had departure delay "), F.col("departure_delay_min").cast("string"),
        F.lit(" minutes and arrival delay "), F.col("arrival_delay_min").cast("string"),
        F.lit(" minutes. Status was "), F.col("status"),
        F.lit(". Weather impact flag was "), _python_bool(F.col("weather_flag")),
        F.lit(". Event timestamp was "), F.col("event_ts"),
        F.lit("."),
    )
    metadata = F.struct("status", "weather_flag", "departure_delay_min", "arrival_delay_min")
    return flights.select(
        F.col("flight_id").alias("doc_id"),
        sentence.alias("content"),
        F.lit(SOURCE_TYPE).alias("source_type"),
        "airline",
        "route",
        F.substring("event_ts", 1, 10).try_cast("date").alias("event_date"),
        F.to_json(metadata, {"ignoreNullFields": "false"}).alias("metadata"),
        *(["updated_ts"] if stamp else []),
    )


def latest_per_doc(rows: DataFrame, tie_breakers: list[str] | None = None) -> DataFrame:
    """The newest row of each document.

    The rank filter also runs before the shuffle, so many versions of one
    document shrink to one row per map task.
    """
    order = [F.desc("updated_ts"), *[F.col(c).asc_nulls_first() for c in tie_breakers or []]]
    newest = Window.partitionBy("doc_id").orderBy(*order)
    return (
        rows.withColumn("rn", F.row_number().over(newest))
        .where(F.col("rn") == 1)
        .transform(except_column, "rn")
    )


def except_column(rows: DataFrame, name: str) -> DataFrame:
    return rows.drop(name)


def upsert_rag_documents(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The target after the rows are merged in by ``doc_id``.

    Untouched target rows pass through an anti join, so a small batch is
    broadcast under Spark's size limit and the target is not shuffled; a batch
    beyond the limit becomes a shuffled join on the unique key.
    """
    source = latest_per_doc(rows, ["content"]).select(*target.columns)
    untouched = target.join(source.select("doc_id"), "doc_id", "left_anti")
    return untouched.select(*target.columns).unionByName(source)


def zip_docs_vectors(documents: DataFrame, vectors: DataFrame) -> DataFrame:
    """Pair each document with its vector by id."""
    return documents.drop("embedding").join(
        vectors.select(F.col("id").alias("doc_id"), "embedding"), "doc_id"
    )


def metadata_defaults(rows: DataFrame, names: list[str]) -> DataFrame:
    """Absent metadata shows as empty text."""
    return rows.withColumns(
        {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names}
    )
