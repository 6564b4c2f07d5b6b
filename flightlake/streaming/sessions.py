"""Session documents kept up to date by a stream of entries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlake.constants import SESSION_ENTRIES, SESSION_TTL_SECONDS
from flightlake.schemas import SESSION_ENTRIES as ENTRY_SCHEMA
from flightlake.session import stateful_session

SESSION_DOCUMENT = (
    "session_id string, turns array<struct<role:string,content:string>>, "
    "prompt_tokens bigint, response_tokens bigint, total_tokens bigint, "
    "request_count bigint, expire_at timestamp"
)


def session_processor(max_entries: int, ttl_seconds: int):
    """A processor that keeps the newest entries and the token totals of one session.

    Entries are merged by number, so the outcome does not depend on arrival
    order within a batch, and only ``max_entries`` of them are held at a time.
    State idle for longer than the limit is dropped by the state store.
    """
    from pyspark.sql.streaming import StatefulProcessor

    class SessionDocuments(StatefulProcessor):
        def init(self, handle):
            ttl = ttl_seconds * 1000
            self.turns = handle.getListState(
                "turns", "entry_no bigint, role string, content string", ttl
            )
            self.totals = handle.getValueState(
                "totals",
                "prompt bigint, response bigint, total bigint, requests bigint, last_us bigint",
                ttl,
            )

        def handleInputRows(self, key, rows, timerValues):
            import pandas as pd

            kept = [tuple(turn) for turn in self.turns.get()] if self.turns.exists() else []
            totals = list(self.totals.get()) if self.totals.exists() else [0, 0, 0, 0, 0]
            for frame in rows:
                new = list(zip(frame["entry_no"].tolist(), frame["role"], frame["content"]))
                kept = sorted(kept + new, key=lambda turn: turn[0])[-max_entries:]
                for slot, name in enumerate(("prompt_tokens", "response_tokens", "total_tokens")):
                    totals[slot] += int(frame[name].fillna(0).sum())
                totals[3] += int(frame["total_tokens"].notna().sum())
                newest = frame["entry_ts"].max().to_datetime64().astype("datetime64[us]")
                totals[4] = max(totals[4], int(newest.astype("int64")))
            self.turns.put(kept)
            self.totals.update(tuple(totals))
            yield pd.DataFrame(
                {
                    "session_id": [key[0]],
                    "turns": [[{"role": t[1], "content": t[2]} for t in kept]],
                    "prompt_tokens": [totals[0]],
                    "response_tokens": [totals[1]],
                    "total_tokens": [totals[2]],
                    "request_count": [totals[3]],
                    "expire_at": [pd.Timestamp(totals[4] + ttl_seconds * 1_000_000, unit="us")],
                }
            )

        def close(self):
            pass

    return SessionDocuments()


def entry_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return (
        stateful_session(spark).readStream.schema(ENTRY_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def session_updates(
    entries: DataFrame,
    max_entries: int = SESSION_ENTRIES,
    ttl_seconds: int = SESSION_TTL_SECONDS,
) -> DataFrame:
    """The changed session documents of each micro-batch."""
    return entries.groupBy("session_id").transformWithStateInPandas(
        session_processor(max_entries, ttl_seconds),
        outputStructType=SESSION_DOCUMENT,
        outputMode="Update",
        timeMode="ProcessingTime",
    )


def stream_sessions(
    entries: DataFrame,
    path: str,
    checkpoint: str,
    max_entries: int = SESSION_ENTRIES,
    ttl_seconds: int = SESSION_TTL_SECONDS,
) -> StreamingQuery:
    """Write the documents that change in each micro-batch to ``path/batch=N``.

    The newest batch of a session is its document. A batch that runs again
    overwrites its own folder. ``entries`` comes from :func:`entry_stream`, whose
    session keeps state in RocksDB, so it may exceed memory, and goes on with no
    empty batches. State expires by the wall clock of the run: a backlog that is
    replayed at once merges what live running would have started afresh.
    """

    def save(documents: DataFrame, batch_id: int) -> None:
        documents.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        session_updates(entries, max_entries, ttl_seconds)
        .writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def keep_sessions(
    entries: DataFrame,
    checkpoint: str,
    max_entries: int = SESSION_ENTRIES,
    ttl_seconds: int = SESSION_TTL_SECONDS,
) -> StreamingQuery:
    """Keep the documents in the stream's own state and write nothing else; :func:`session_state` reads them."""
    return (
        session_updates(entries, max_entries, ttl_seconds)
        .writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def session_state(
    spark: SparkSession,
    checkpoint: str,
    ttl_seconds: int = SESSION_TTL_SECONDS,
    at: dt.datetime | None = None,
) -> DataFrame:
    """The documents of all sessions as of the last finished micro-batch of :func:`keep_sessions`.

    Sessions whose state has run out at the moment ``at`` (by the wall clock of the
    stream's runs; now, if not given) are left out, also if the store still holds
    them. A session has at most as many turns as the stream keeps, so they fit one
    row; both parts are grouped by session and joined without a further shuffle.
    """
    moment = int((at or dt.datetime.now(dt.timezone.utc)).timestamp() * 1000)

    def variable(name: str, column: str) -> DataFrame:
        held = spark.read.format("statestore").option("stateVarName", name).load(checkpoint)
        return held.where(F.col(f"{column}.ttlExpirationMs") > moment).select(
            "key.session_id", F.col(f"{column}.value").alias("held")
        )

    turn = F.struct("held.entry_no", "held.role", "held.content")
    in_order = F.transform(
        F.sort_array(F.collect_list(turn)),
        lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")),
    )
    turns = variable("turns", "list_element").groupBy("session_id").agg(in_order.alias("turns"))
    totals = variable("totals", "value").select(
        "session_id",
        F.col("held.prompt").alias("prompt_tokens"),
        F.col("held.response").alias("response_tokens"),
        F.col("held.total").alias("total_tokens"),
        F.col("held.requests").alias("request_count"),
        F.timestamp_micros(F.col("held.last_us") + F.lit(ttl_seconds * 1_000_000)).alias("expire_at"),
    )
    documents = totals.join(turns, "session_id", "left")
    none = F.array().cast("array<struct<role:string,content:string>>")
    return documents.withColumn("turns", F.coalesce("turns", none)).select(
        "session_id", "turns", "prompt_tokens", "response_tokens", "total_tokens", "request_count", "expire_at"
    )
