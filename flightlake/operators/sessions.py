"""Session memory as tables: last entries, token totals, expiry."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.constants import SESSION_ENTRIES, SESSION_TTL_SECONDS


def last_turns(entries: DataFrame, max_entries: int = SESSION_ENTRIES) -> DataFrame:
    """The newest entries of each session.

    Each map task keeps at most ``max_entries`` rows of a session before the
    shuffle, so one very long session does not reach a single task whole.
    """
    newest = Window.partitionBy("session_id").orderBy(F.desc("entry_no"))
    return (
        entries.withColumn("_rank", F.row_number().over(newest))
        .where(F.col("_rank") <= max_entries)
        .drop("_rank")
    )


def session_history(entries: DataFrame, max_entries: int = SESSION_ENTRIES) -> DataFrame:
    """One row per session: its last entries in order, and how many question turns they hold."""
    turn = F.struct("entry_no", "role", "content")
    ordered = F.sort_array(F.collect_list(turn))
    turns = F.transform(
        ordered, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))
    )
    return (
        last_turns(entries, max_entries)
        .groupBy("session_id")
        .agg(turns.alias("turns"))
        .withColumn("history_turns", F.floor(F.size("turns") / F.lit(2)).cast("int"))
    )


def token_totals() -> list[Column]:
    """Token sums, and the number of rows that carry usage."""

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name)

    return [
        total("prompt_tokens"),
        total("response_tokens"),
        total("total_tokens"),
        F.count_if(F.col("total_tokens").isNotNull()).alias("request_count"),
    ]


def session_tokens(usage: DataFrame) -> DataFrame:
    return usage.groupBy("session_id").agg(*token_totals())


def expire_at(entry_ts: str = "entry_ts", ttl_seconds: int = SESSION_TTL_SECONDS) -> Column:
    return F.max(entry_ts) + F.make_dt_interval(secs=F.lit(float(ttl_seconds)))


def live_sessions(
    entries: DataFrame, now: dt.datetime, ttl_seconds: int = SESSION_TTL_SECONDS
) -> DataFrame:
    """Sessions whose last entry is not older than the idle limit."""
    moment = F.lit(now.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return (
        entries.groupBy("session_id")
        .agg(expire_at(ttl_seconds=ttl_seconds).alias("expire_at"))
        .where(F.col("expire_at").cast("timestamp_ntz") > moment)
    )


def clear_sessions(entries: DataFrame, cleared: DataFrame) -> DataFrame:
    """Entries without those of explicitly cleared sessions."""
    return entries.join(cleared.select("session_id").distinct(), "session_id", "left_anti")


def session_documents(
    entries: DataFrame,
    max_entries: int = SESSION_ENTRIES,
    ttl_seconds: int = SESSION_TTL_SECONDS,
) -> DataFrame:
    """Session documents: last entries, token totals and expiry time.

    Both aggregates end partitioned by session, so joining them needs no
    further shuffle.
    """
    totals = entries.groupBy("session_id").agg(
        *token_totals(), expire_at(ttl_seconds=ttl_seconds).alias("expire_at")
    )
    return session_history(entries, max_entries).join(totals, "session_id")
