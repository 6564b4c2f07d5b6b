"""Schemas of the tables that cross a file boundary."""

from pyspark.sql import types as T

from flightlake.constants import FLIGHT_FIELDS

BRONZE = T.StructType([T.StructField(name, T.StringType()) for name in FLIGHT_FIELDS])

SILVER = T.StructType(
    [
        T.StructField("flight_id", T.StringType()),
        T.StructField("airline", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("departure_delay_min", T.IntegerType()),
        T.StructField("arrival_delay_min", T.IntegerType()),
        T.StructField("weather_flag", T.BooleanType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)

RAG_DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.StringType(), False),
        T.StructField("content", T.StringType(), False),
        T.StructField("source_type", T.StringType()),
        T.StructField("airline", T.StringType()),
        T.StructField("route", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        T.StructField("metadata", T.StringType()),
        T.StructField("updated_ts", T.TimestampType(), False),
    ]
)

VECTORS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
    ]
)

LOG_PAYLOAD = T.StructType(
    [
        T.StructField("event", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("response_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType()),
        T.StructField("guardrail_type", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("vs_results", T.LongType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("severity", T.StringType()),
        T.StructField("jsonPayload", LOG_PAYLOAD),
        T.StructField("log_date", T.DateType()),
    ]
)

# the same log, its payload as it was written: fields may be missing, further ones are kept
VARIANT_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("severity", T.StringType()),
        T.StructField("jsonPayload", T.VariantType()),
        T.StructField("log_date", T.DateType()),
    ]
)

SAMPLE = T.StructType(
    [
        T.StructField("flight_id", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("departure_time", T.TimestampType()),
        T.StructField("arrival_time", T.TimestampType()),
        T.StructField("aircraft_type", T.StringType()),
        T.StructField("passenger_count", T.IntegerType()),
    ]
)

SESSION_ENTRIES = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("entry_no", T.LongType()),
        T.StructField("entry_ts", T.TimestampType()),
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("prompt_tokens", T.LongType()),
        T.StructField("response_tokens", T.LongType()),
        T.StructField("total_tokens", T.LongType()),
    ]
)
