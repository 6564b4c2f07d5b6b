"""Reports over the request log: token use, guardrails, fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.constants import (
    EVENT_FALLBACK,
    EVENT_GUARDRAIL,
    EVENT_TOKENS,
    EXPORTED_EVENTS,
    GUARDRAIL_EVENTS,
    MIN_VECTOR_HITS,
)
from flightlake.schemas import LOG_PAYLOAD


def payload(records: DataFrame, name: str) -> Column:
    """A payload field, of a struct or of a variant; what a variant can't give as the field's type is null."""
    if isinstance(records.schema["jsonPayload"].dataType, T.VariantType):
        wanted = LOG_PAYLOAD[name].dataType.simpleString()
        return F.try_variant_get("jsonPayload", f"$.{name}", wanted)
    return F.col(f"jsonPayload.{name}")


def log_export_filter(records: DataFrame) -> DataFrame:
    """The three event types that leave the service's log."""
    return records.where(payload(records, "event").isin(EXPORTED_EVENTS))


def log_fields(records: DataFrame) -> DataFrame:
    """What the payloads of a variant log hold: entries per event, field and type, and whether reports know it.

    A payload that is no object counts under a null field. One pass over the log,
    summed in the map tasks; the result has a row per kind of field.
    """
    event = payload(records, "event").alias("event")
    fields = records.select(event, "jsonPayload").lateralJoin(
        records.sparkSession.tvf.variant_explode_outer(F.col("jsonPayload").outer())
    )
    return (
        fields.groupBy(
            "event", F.col("key").alias("field"), F.lower(F.schema_of_variant("value")).alias("type")
        )
        .agg(F.count("*").alias("entries"))
        .withColumn("known", F.coalesce(F.col("field").isin(LOG_PAYLOAD.names), F.lit(False)))
    )


def token_usage_rows(records: DataFrame) -> DataFrame:
    tokens = [
        payload(records, name).cast("bigint").alias(name)
        for name in ("prompt_tokens", "response_tokens", "total_tokens")
    ]
    return records.where(payload(records, "event") == EVENT_TOKENS).select(
        "timestamp",
        F.date_trunc("hour", "timestamp").alias("hour"),
        payload(records, "session_id").alias("session_id"),
        payload(records, "endpoint").alias("endpoint"),
        *tokens,
    )


def guardrail_rows(records: DataFrame) -> DataFrame:
    return records.where(payload(records, "event").isin(GUARDRAIL_EVENTS)).select(
        "timestamp",
        F.date_trunc("hour", "timestamp").alias("hour"),
        payload(records, "event").alias("event_type"),
        payload(records, "guardrail_type").alias("guardrail_type"),
        payload(records, "reason").alias("reason"),
        payload(records, "session_id").alias("session_id"),
        payload(records, "vs_results").cast("bigint").alias("vs_results"),
        "severity",
    )


def tokens_by_endpoint(usage: DataFrame, grain: str = "day") -> DataFrame:
    """Prompt and response tokens per endpoint and day (or week)."""
    return usage.groupBy("endpoint", F.to_date(F.date_trunc(grain, "hour")).alias(grain)).agg(
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("response_tokens").alias("response_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
    )


def top_sessions(usage: DataFrame, top: int = 10) -> DataFrame:
    return (
        usage.groupBy("session_id")
        .agg(F.sum("total_tokens").alias("total_tokens"))
        .orderBy(F.desc("total_tokens"), "session_id")
        .limit(top)
    )


def rejections_by_type(guardrails: DataFrame, hourly: bool = False) -> DataFrame:
    keys = ["guardrail_type", *(["hour"] if hourly else [])]
    return (
        guardrails.where(F.col("event_type") == EVENT_GUARDRAIL)
        .groupBy(*keys)
        .agg(F.count("*").alias("rejections"))
    )


def fallback_rate(records: DataFrame) -> DataFrame:
    """Share of answered retrieval requests that had fewer than three vector hits."""
    served = (payload(records, "event") == EVENT_TOKENS) & (payload(records, "endpoint") == "/retrieve")
    sparse = (payload(records, "event") == EVENT_FALLBACK) & (payload(records, "vs_results") < MIN_VECTOR_HITS)
    return records.agg(
        F.count_if(served).alias("requests"), F.count_if(sparse).alias("fallbacks")
    ).withColumn(
        "fallback_rate", F.round(F.try_divide(F.col("fallbacks").cast("double"), "requests"), 6)
    )


def run_tokens(events: DataFrame) -> DataFrame:
    """Tokens of a run over all its messages; messages without usage add nothing."""
    return events.groupBy("run_id").agg(
        F.coalesce(F.sum("tokens"), F.lit(0).cast("bigint")).alias("total_tokens")
    )
