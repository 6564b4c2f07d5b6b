import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from flightlake.operators import evals, logs, sessions
from flightlake.plans import medallion
from flightlake.schemas import BRONZE, SESSION_ENTRIES, VARIANT_LOG
from flightlake.session import work_folder
from flightlake.sources import bronze, runlog
from flightlake.streaming import flights as flight_stream
from flightlake.streaming import logs as log_stream
from flightlake.streaming import sessions as session_stream


def flight_rows(spark, numbers, day):
    return spark.createDataFrame(
        [(f"F{n}", "AA", "ATL", "LAX", "5", "6", "FALSE", "ON_TIME", f"{day}T10:00:{n:02d}+00:00")
         for n in numbers],
        BRONZE,
    ).withColumn("date", F.lit(day))


def test_late_files_are_kept_and_old_ids_known(spark):
    root, path, offsets = (work_folder(spark, n) for n in ("raw", "silver", "offsets"))
    waves = ((range(5), "2024-03-01"), (range(3, 9), "2024-01-02"), (range(1, 2), "2024-03-20"))
    for numbers, day in waves:
        bronze.write_bronze(flight_rows(spark, numbers, day), root)
        flight_stream.stream_bronze_to_silver(spark, root, path, offsets).awaitTermination()
    rows = spark.read.parquet(path).collect()
    assert sorted(r["flight_id"] for r in rows) == [f"F{n}" for n in range(9)]


def test_exact_stream_keeps_late_files_and_knows_old_ids(spark):
    root, path, offsets = (work_folder(spark, n) for n in ("raw", "silver", "offsets"))
    waves = ((range(5), "2024-03-01"), (range(3, 9), "2024-01-02"), (range(1, 2), "2024-03-02"))
    for numbers, day in waves:
        bronze.write_bronze(flight_rows(spark, numbers, day), root)
        flight_stream.stream_silver_exact(spark, root, path, offsets).awaitTermination()
    rows = spark.read.parquet(path).collect()
    assert sorted(r["flight_id"] for r in rows) == [f"F{n}" for n in range(9)]
    assert {str(r["ingest_date"]) for r in rows if r["batch"] == 1} == {"2024-01-02"}
    assert not [r for r in rows if r["batch"] == 2]


def test_seen_ids_are_joined_where_they_lie(spark):
    """No Silver scan and no shuffle of the index; ids of the own batch don't count."""
    silver, table = work_folder(spark, "silver"), f"seen_{uuid.uuid4().hex}"
    flight_stream.open_seen_ids(spark, table, f"{silver}_seen", silver, 4)
    for batch in (0, 1):
        ids = spark.range(batch * 500, batch * 500 + 500).select(
            F.concat(F.lit("F"), "id").alias("flight_id"), F.lit(batch).cast("bigint").alias("batch")
        )
        flight_stream.add_seen_ids(ids, table, 4)
    own = work_folder(spark, "own")
    spark.range(400, 1200).select(F.concat(F.lit("F"), "id").alias("flight_id")).write.parquet(own)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = flight_stream.unseen_flights(spark.read.parquet(own), spark.table(table), 1)
        text = fresh._jdf.queryExecution().executedPlan().toString()
        rows = {r["flight_id"] for r in fresh.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert rows == {f"F{n}" for n in range(500, 1200)}
    assert text.count("Exchange") == 1 and "Bucketed: true" in text and silver + "," not in text
    index = text[text.rindex("Exchange") :]
    assert index.count("FileScan") == 2


def test_a_lost_or_missing_index_is_found_again(spark):
    root, path, offsets = (work_folder(spark, n) for n in ("raw", "silver", "offsets"))
    for number, days in enumerate(("2024-03-01", "2024-01-02", "2024-03-05")):
        bronze.write_bronze(flight_rows(spark, range(4), days), root)
        table = f"seen_{uuid.uuid4().hex}"
        flight_stream.stream_silver_exact(
            spark, root, path, offsets, seen_table=table, buckets=4
        ).awaitTermination()
        spark.sql(f"DROP TABLE {table}")
        assert spark.read.parquet(path).count() == 4, number
    other = f"seen_{uuid.uuid4().hex}"
    flight_stream.open_seen_ids(spark, other, work_folder(spark, "anew"), path, 4)
    assert sorted(r["flight_id"] for r in spark.table(other).collect()) == ["F0", "F1", "F2", "F3"]


def test_job_metrics_come_from_one_pass(spark):
    root = work_folder(spark, "raw")
    rows = flight_rows(spark, range(6), "2024-01-01")
    bad = rows.withColumn("airline", F.when(F.col("flight_id") != "F0", F.col("airline")))
    bronze.write_bronze(bad.unionByName(rows.where("flight_id = 'F1'")), root)
    metrics = medallion.bronze_to_silver(spark, root, "silver_metrics", work_folder(spark, "s"))
    assert (metrics["raw_rows"], metrics["clean_rows"]) == (7, 5)
    medallion.bronze_to_silver(spark, root, "silver_metrics", work_folder(spark, "s"))
    assert spark.table("silver_metrics").count() == 5


def entry(session, number, minute, tokens=None):
    when = dt.datetime(2024, 1, 1, 10, minute)
    role = "user" if number % 2 == 0 else "assistant"
    return (session, number, when, role, f"t{number}", tokens, tokens, tokens)


def test_session_stream_equals_batch_over_several_batches(spark):
    source, path, offsets = (work_folder(spark, n) for n in ("in", "out", "offsets"))
    waves = [
        [entry("a", n, n, 10 if n % 2 else None) for n in range(6)],
        [entry("a", n, n, 1) for n in range(6, 9)] + [entry("b", 0, 3)],
    ]
    for wave in waves:
        spark.createDataFrame(wave, SESSION_ENTRIES).write.mode("append").parquet(source)
        session_stream.stream_sessions(
            session_stream.entry_stream(spark, source), path, offsets, max_entries=4
        ).awaitTermination()
    everything = spark.createDataFrame([e for wave in waves for e in wave], SESSION_ENTRIES)
    batch = sessions.session_documents(everything, 4).drop("history_turns")
    streamed = spark.read.parquet(path)
    fields = [n for n in streamed.columns if n not in ("session_id", "batch")]
    newest = streamed.groupBy("session_id").agg(F.max_by(F.struct(*fields), "batch").alias("d"))

    def rows(df):
        return sorted(map(str, df.select(*sorted(batch.columns)).collect()))

    assert rows(newest.select("session_id", "d.*")) == rows(batch)
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_hourly_tokens_take_late_events_and_open_hours(spark):
    source, path, offsets = (work_folder(spark, n) for n in ("log", "hours", "offsets"))
    hours = [dt.datetime(2024, 1, 1, h, 30) for h in (10, 12, 9, 12)]
    for n, at in enumerate(hours):
        runlog.write_run_log(log_rows(spark, [(at, "INFO", "token_usage", "/agent", n + 1)]), source, "json")
        log_stream.stream_hourly_tokens(
            log_stream.log_stream(spark, source), path, offsets
        ).awaitTermination()
    sums = {r["hour"].hour: r["total_tokens"] for r in log_stream.read_hourly_tokens(spark, path).collect()}
    assert sums == {10: 1, 12: 6, 9: 3}


def files_below(path):
    return sum(len(names) for _, _, names in os.walk(path))


def test_state_of_fifty_batches_equals_the_batch_and_stays_small(spark):
    source, offsets = work_folder(spark, "log"), work_folder(spark, "offsets")
    at = dt.datetime(2024, 1, 1)
    events = [
        (at + dt.timedelta(hours=7 * n % 30), "INFO", "token_usage", f"/{n % 3}", n) for n in range(150)
    ]
    rows = log_rows(spark, events).repartitionByRange(50, "jsonPayload.total_tokens")
    rows.write.format("json").option("timestampFormat", runlog.MICROSECONDS).save(source)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        records = log_stream.log_stream(spark, source, files_per_batch=1)
        running = log_stream.keep_hourly_tokens(records, offsets)
        running.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    batches = running.lastProgress["batchId"] + 1
    assert batches >= 50
    state = log_stream.hourly_tokens_state(spark, offsets)
    kept = sorted(map(tuple, state.collect()), key=repr)
    expected = log_stream.hourly_tokens(log_rows(spark, events)).select(*state.columns)
    assert kept == sorted(map(tuple, expected.collect()), key=repr)
    # offsets and commits of more batches than a restart may need are gone
    assert files_below(f"{offsets}/commits") < batches and files_below(f"{offsets}/offsets") < batches


def test_session_state_equals_batch_and_leaves_out_idle_sessions(spark):
    source, offsets = work_folder(spark, "in"), work_folder(spark, "offsets")
    waves = [
        [entry("a", n, n, 10 if n % 2 else None) for n in range(6)],
        [entry("a", n, n, 1) for n in range(6, 9)] + [entry("b", 0, 3), entry(None, 0, 4)],
    ]
    for wave in waves:
        spark.createDataFrame(wave, SESSION_ENTRIES).write.mode("append").parquet(source)
        session_stream.keep_sessions(
            session_stream.entry_stream(spark, source), offsets, max_entries=4
        ).awaitTermination()
    everything = spark.createDataFrame([e for w in waves for e in w if e[0]], SESSION_ENTRIES)
    batch = sessions.session_documents(everything, 4).drop("history_turns")
    state = session_stream.session_state(spark, offsets).where("session_id IS NOT NULL")

    def rows(df):
        return sorted(map(str, df.select(*sorted(batch.columns)).collect()))

    assert rows(state) == rows(batch)
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(hours=2)
    assert session_stream.session_state(spark, offsets, at=later).count() == 0


VARIANT_LINES = [
    '{"timestamp":"2024-01-05T10:00:00Z","severity":"INFO","jsonPayload":{"event":"token_usage",'
    '"endpoint":"/retrieve","total_tokens":"many","prompt_tokens":"12","trace":{"span":[1,2]}}}',
    '{"timestamp":"2024-01-05T10:30:00Z","severity":"INFO","jsonPayload":{"event":"token_usage","total_tokens":7}}',
    '{"timestamp":"2024-01-05T11:00:00Z","severity":"INFO","jsonPayload":"plain text"}',
    '{"timestamp":"2024-01-05T11:00:00Z","severity":"INFO"}',
    "{broken",
]


def variant_folder(spark):
    path = work_folder(spark, "variant-log")
    os.makedirs(f"{path}/log_date=2024-01-05")
    with open(f"{path}/log_date=2024-01-05/log.json", "w") as lines:
        lines.write("\n".join(VARIANT_LINES))
    return path


def test_variant_payloads_of_any_shape_are_read(spark):
    path = variant_folder(spark)
    log = runlog.read_run_log(spark, path, dt.datetime(2024, 1, 6), 30, "json", VARIANT_LOG)
    assert log.count() == len(VARIANT_LINES)
    usage = logs.token_usage_rows(log).orderBy("timestamp").collect()
    assert [(r["prompt_tokens"], r["total_tokens"]) for r in usage] == [(12, None), (None, 7)]
    rate = logs.fallback_rate(log).collect()[0]
    assert (rate["requests"], rate["fallbacks"]) == (1, 0)
    fields = {(r["event"], r["field"], r["type"]): (r["entries"], r["known"]) for r in logs.log_fields(log).collect()}
    assert fields["token_usage", "total_tokens", "string"] == (1, True)
    assert fields["token_usage", "total_tokens", "bigint"] == (1, True)
    assert fields["token_usage", "trace", "object<span: array<bigint>>"] == (1, False)
    assert sum(n for (event, field, _), (n, _) in fields.items() if field is None) == 3
    assert logs.log_fields(log.limit(0)).count() == 0


def test_variant_export_keeps_unknown_fields_and_reads_few(spark):
    path, offsets = work_folder(spark, "export"), work_folder(spark, "offsets")
    records = log_stream.log_stream(spark, variant_folder(spark), schema=VARIANT_LOG)
    log_stream.stream_run_log(records, path, offsets).awaitTermination()
    log = runlog.read_run_log(spark, path, dt.datetime(2024, 1, 6), schema=VARIANT_LOG)
    spans = log.select(F.try_variant_get("jsonPayload", "$.trace.span[1]", "int")).collect()
    assert sorted(s[0] or 0 for s in spans) == [0, 2]
    plan = logs.tokens_by_endpoint(logs.token_usage_rows(log))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan
    # the scan hands on the fields asked for, not whole payloads
    assert "variant" not in plan[plan.index("ReadSchema") :].split("\n")[0]


def log_rows(spark, events):
    schema = "log_ts timestamp, severity string, event string, endpoint string, total_tokens bigint"
    return runlog.log_records(spark.createDataFrame(events, schema))


def test_log_stream_drops_unexported_events(spark):
    at = dt.datetime(2024, 1, 1, 10, 15, 0, 123456)
    source, path, offsets = (work_folder(spark, n) for n in ("log", "export", "offsets"))
    records = log_rows(
        spark,
        [(at, "INFO", "token_usage", "/agent", 5), (at, "INFO", "router_decision", None, None),
         (at, None, "bq_fallback", None, None)],
    )
    runlog.write_run_log(records, source, "json")
    log_stream.stream_run_log(
        log_stream.log_stream(spark, source), path, offsets
    ).awaitTermination()
    exported = spark.read.parquet(path).collect()
    assert {r["jsonPayload"]["event"] for r in exported} == {"token_usage", "bq_fallback"}
    assert {r["timestamp"] for r in exported} == {at}
    assert {r["severity"] for r in exported} == {"INFO"}


def test_retention_prunes_day_folders(spark):
    path = work_folder(spark, "log")
    days = [dt.datetime(2024, 1, d, 12) for d in (1, 15, 31)]
    runlog.write_run_log(log_rows(spark, [(d, "INFO", "token_usage", None, 1) for d in days]), path)
    kept = runlog.read_run_log(spark, path, dt.datetime(2024, 1, 31, 6), days=16)
    assert sorted(str(r["log_date"]) for r in kept.collect()) == ["2024-01-31"]
    exact = runlog.read_run_log(spark, path, dt.datetime(2024, 1, 31), days=16)
    assert exact.count() == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(log_date" in plan


def test_rate_of_an_empty_log_is_null(spark):
    empty = log_rows(spark, [])
    assert logs.fallback_rate(empty).collect()[0]["fallback_rate"] is None


# --- sessions and runs ---


def test_only_idle_sessions_expire(spark):
    rows = spark.createDataFrame(
        [entry("a", 0, 0), entry("a", 1, 30), entry("b", 0, 0)], SESSION_ENTRIES
    )
    live = sessions.live_sessions(rows, dt.datetime(2024, 1, 1, 11, 10))
    assert [r["session_id"] for r in live.collect()] == ["a"]


def test_a_long_session_keeps_its_last_twenty(spark):
    rows = spark.range(5000).select(
        F.lit("s").alias("session_id"),
        F.col("id").alias("entry_no"),
        F.lit("user").alias("role"),
        F.col("id").cast("string").alias("content"),
    )
    history = sessions.session_history(rows.repartition(4)).collect()[0]
    assert [t["content"] for t in history["turns"]] == [str(n) for n in range(4980, 5000)]
    assert history["history_turns"] == 10


def run(spark, *authors):
    rows = [(1, n, a) for n, a in enumerate(authors)]
    return spark.createDataFrame(rows, "run_id bigint, event_no bigint, author string")


@pytest.mark.parametrize(
    "authors, verdict",
    [
        (["risk_analyst", "mitigation_advisor"], "PASS"),
        (["risk_analyst", "risk_analyst", None, "mitigation_advisor"], "PASS"),
        (["mitigation_advisor", "risk_analyst"], "FAIL"),
        (["risk_analyst", "mitigation_advisor", "risk_analyst"], "FAIL"),
        (["risk_analyst", "weather_analyst", "mitigation_advisor"], "FAIL"),
        (["risk_analyst"], "FAIL"),
    ],
)
def test_trajectory(spark, authors, verdict):
    assert evals.eval_trajectory(run(spark, *authors)).collect()[0]["trajectory"] == verdict


@pytest.mark.parametrize(
    "constraint, authors, verdict",
    [
        ("exactly_pipeline_health", ["pipeline_health", "pipeline_health"], "PASS"),
        ("exactly_pipeline_health", ["pipeline_health", "risk_analyst"], "FAIL"),
        ("mitigation_after_risk", ["risk_analyst", "mitigation_advisor", "risk_analyst"], "PASS"),
        ("mitigation_after_risk", ["mitigation_advisor", "risk_analyst"], "FAIL"),
        ("no_mitigation_for_pure_weather", ["weather_analyst"], "PASS"),
        ("no_mitigation_for_pure_weather", ["risk_analyst"], "FAIL"),
    ],
)
def test_routing(spark, constraint, authors, verdict):
    cases = spark.createDataFrame([(1, constraint)], "run_id bigint, constraint string")
    assert evals.eval_routing(cases, run(spark, *authors)).collect()[0]["routing"] == verdict


def test_an_idle_session_starts_afresh(spark):
    import time

    source, path, offsets = (work_folder(spark, n) for n in ("in", "out", "offsets"))
    for wave in ([entry("a", 0, 0), entry("a", 1, 1, 5)], [entry("a", 2, 2), entry("a", 3, 3, 7)]):
        spark.createDataFrame(wave, SESSION_ENTRIES).write.mode("append").parquet(source)
        session_stream.stream_sessions(
            session_stream.entry_stream(spark, source), path, offsets, ttl_seconds=1
        ).awaitTermination()
        time.sleep(3)
    last = spark.read.parquet(path).orderBy(F.desc("batch")).first()
    assert [t["content"] for t in last["turns"]] == ["t2", "t3"]
    assert (last["total_tokens"], last["request_count"]) == (7, 1)
