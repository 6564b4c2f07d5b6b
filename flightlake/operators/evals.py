"""Checks over a table of logged agent runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.constants import (
    ANSWER_KEYWORDS,
    CHAIN_CALLS,
    DECISION_KEYWORDS,
    EXPECTED_CHAIN,
    MIN_ANSWER_CHARS,
    RESPONSE_FIELDS,
    ROUTING_HEALTH_ONLY,
    ROUTING_RISK_FIRST,
    ROUTING_WEATHER_ONLY,
    TOKENS_PER_CALL,
    WORKER_HEALTH,
    WORKER_MITIGATION,
    WORKER_RISK,
    WORKER_WEATHER,
)
from flightlake.functions.text import contains_any, count_contained
from flightlake.operators.facts import best_for_filters, decision


def verdict(passed: Column) -> Column:
    return F.when(passed, "PASS").otherwise("FAIL")


def _first(author: str) -> Column:
    return F.min(F.when(F.col("author") == author, F.col("event_no")))


def _last(author: str) -> Column:
    return F.max(F.when(F.col("author") == author, F.col("event_no")))


def eval_trajectory(events: DataFrame) -> DataFrame:
    """Did a run go through exactly the expected agents, in order?

    The agent sequence with repeats removed equals (first, second) exactly when
    nobody else appears and the first agent's last event precedes the second's
    first. That is an aggregate, so a run with very many events is combined in
    the map tasks and never ordered in one.
    """
    first, second = EXPECTED_CHAIN
    named = events.where(F.col("author").isNotNull())
    summary = named.groupBy("run_id").agg(
        F.count_if(~F.col("author").isin(EXPECTED_CHAIN)).alias("others"),
        _last(first).alias("first_end"),
        _first(second).alias("second_start"),
    )
    ordered = (F.col("others") == 0) & (F.col("first_end") < F.col("second_start"))
    return summary.select(
        "run_id", verdict(F.coalesce(ordered, F.lit(False))).alias("trajectory")
    )


def agent_transitions(events: DataFrame, span: int = 10_000) -> DataFrame:
    """The events of a run at which another agent takes over.

    Each event needs its predecessor's author. Events are compared within spans
    of their number, and the first of a span with the last of the span before
    it, so that a run with very many events is spread over many tasks.
    """
    named = events.where(F.col("author").isNotNull()).withColumn(
        "span", F.floor(F.col("event_no") / F.lit(span))
    )
    within = Window.partitionBy("run_id", "span").orderBy("event_no")
    spans = Window.partitionBy("run_id").orderBy("span")
    last = (
        named.groupBy("run_id", "span")
        .agg(F.max_by("author", "event_no").alias("last_author"))
        .withColumn("before_span", F.lag("last_author").over(spans))
        .drop("last_author")
    )
    steps = named.withColumn("previous", F.lag("author").over(within)).join(last, ["run_id", "span"])
    previous = F.coalesce("previous", "before_span")
    changed = previous.isNull() | (previous != F.col("author"))
    return steps.where(changed).select("run_id", "event_no", "author")


def workers_called(events: DataFrame) -> DataFrame:
    """Names of the workers of a run in order of their first call."""
    firsts = (
        events.where(F.col("author").isNotNull())
        .groupBy("run_id", "author")
        .agg(F.min("event_no").alias("first_no"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("first_no", "author")))
    return firsts.groupBy("run_id").agg(
        F.transform(ordered, lambda step: step["author"]).alias("workers_called")
    )


def worker_calls(events: DataFrame) -> DataFrame:
    """First call of each worker in a run, and how many workers were called."""
    return events.where(F.col("author").isNotNull()).groupBy("run_id").agg(
        F.count_distinct("author").alias("workers"),
        _first(WORKER_HEALTH).alias("health_at"),
        _first(WORKER_RISK).alias("risk_at"),
        _first(WORKER_WEATHER).alias("weather_at"),
        _first(WORKER_MITIGATION).alias("mitigation_at"),
    )


def eval_routing(cases: DataFrame, events: DataFrame) -> DataFrame:
    """Does a run respect the routing constraint of its case?"""
    met = (
        F.when(
            F.col("constraint") == ROUTING_HEALTH_ONLY,
            (F.col("workers") == 1) & F.col("health_at").isNotNull(),
        )
        .when(F.col("constraint") == ROUTING_RISK_FIRST, F.col("risk_at") < F.col("mitigation_at"))
        .when(
            F.col("constraint") == ROUTING_WEATHER_ONLY,
            F.col("mitigation_at").isNull() & F.col("weather_at").isNotNull(),
        )
    )
    return (
        cases.join(worker_calls(events), "run_id", "left")
        .withColumn("workers_called", F.coalesce("workers", F.lit(0).cast("bigint")))
        .select(
            "run_id",
            "constraint",
            "workers_called",
            verdict(F.coalesce(met, F.lit(False))).alias("routing"),
        )
    )


def token_budget(total: Column, calls: Column) -> Column:
    return verdict((total > 0) & (total <= calls * F.lit(TOKENS_PER_CALL)))


def eval_token_budget(runs: DataFrame, calls: Column | None = None) -> DataFrame:
    """Tokens of a run against its ceiling; the fixed chain makes two calls."""
    count = F.lit(CHAIN_CALLS) if calls is None else calls
    return runs.select(
        "run_id", token_budget(F.col("total_tokens"), count).alias("token_budget")
    )


def one_decimal(value: Column) -> Column:
    """A fact's number as it is printed in answers: 42.0, 7.5."""
    return value.cast("decimal(18,1)").cast("string")


def with_ground_truth(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Runs beside the row their case is judged by: the slowest pair after its optional filters.

    runs: a case's ``airline`` and ``route``, null or empty for none, in any case;
    pairs: the risk rows per airline and route. ``has_truth`` is null for a case
    whose filters leave no row.
    """

    def given(name: str) -> Column:
        return F.upper(F.nullif(F.col(name), F.lit("")))

    cases = runs.withColumns({"f_airline": given("airline"), "f_route": given("route")})
    truth = best_for_filters(
        cases.select("f_airline", "f_route").distinct(),
        pairs.select("airline", "route", "avg_delay_min", "weather_pct"),
        [F.desc("avg_delay_min"), F.col("airline"), F.col("route")],
        top=1,
    ).withColumn("has_truth", F.lit(True))
    same = F.col("c.f_airline").eqNullSafe(F.col("t.f_airline")) & F.col("c.f_route").eqNullSafe(
        F.col("t.f_route")
    )
    return cases.alias("c").join(truth.alias("t"), same, "left").select(
        *[f"c.{name}" for name in runs.columns], "t.avg_delay_min", "t.weather_pct", "t.has_truth"
    )


def is_skipped() -> Column:
    return F.col("has_truth").isNull()


def eval_skipped(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cases that can't be judged: no row is left by their filters."""
    return with_ground_truth(runs, pairs).select("run_id", is_skipped().alias("skipped"))


def eval_grounding(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Does the answer cite a number of its ground-truth row?"""
    cited = F.regexp_extract_all(F.col("answer"), F.lit(r"(\d+\.?\d*)"))
    expected = F.array(one_decimal(F.col("avg_delay_min")), one_decimal(F.col("weather_pct")))
    return (
        with_ground_truth(runs, pairs)
        .where(~is_skipped())
        .select(
            "run_id",
            verdict(F.coalesce(F.arrays_overlap(cited, expected), F.lit(False))).alias("grounding"),
        )
    )


def eval_correctness(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Does the answer hold a keyword of the decision its ground truth calls for?"""
    judged = (
        with_ground_truth(runs, pairs)
        .where(~is_skipped())
        .withColumn("expected", decision(F.col("avg_delay_min"), F.col("weather_pct")))
    )
    answer = F.lower("answer")
    matched = F.lit(False)
    for name, words in DECISION_KEYWORDS.items():
        matched = matched | ((F.col("expected") == name) & contains_any(answer, words))
    return judged.select("run_id", "expected", verdict(matched).alias("correctness"))


def architecture_comparison(runs: DataFrame) -> DataFrame:
    """Tokens and tool calls of the same question under each architecture."""
    return (
        runs.groupBy("question")
        .pivot("architecture", ["agent", "multi_agent", "coordinate"])
        .agg(
            F.sum("total_tokens").alias("total_tokens"),
            F.sum("tool_calls").alias("tool_calls"),
        )
    )


def answer_keywords(answers: DataFrame, use_case: str) -> DataFrame:
    """How many expected words an answer holds, and whether that is enough."""
    words, wanted = ANSWER_KEYWORDS[use_case]
    matched = count_contained(F.lower("answer"), words)
    return answers.select(
        "request_id",
        matched.alias("keyword_matches"),
        (matched >= wanted).alias("has_keywords"),
    )


def response_contract(responses: DataFrame) -> DataFrame:
    """Number of broken rules per response: fields, answer length, counts."""
    broken = F.lit(0)
    for name in RESPONSE_FIELDS:
        broken = broken + F.col(name).isNull().cast("int")
    short = F.coalesce(F.length("answer") <= MIN_ANSWER_CHARS, F.lit(True))
    broken = broken + short.cast("int")
    for name in ("context_count", "facts_count"):
        broken = broken + F.coalesce(F.col(name) < 0, F.lit(True)).cast("int")
    return responses.select(
        "request_id", broken.alias("failures"), (broken == 0).alias("valid")
    )


def all_checks_passed(reports: DataFrame, checks: list[str]) -> DataFrame:
    """One row: did no check fail? Skipped checks are NULL and do not count."""
    clean = F.lit(True)
    for name in checks:
        clean = clean & F.coalesce(F.col(name) != "FAIL", F.lit(True))
    return reports.agg(
        F.count("*").alias("runs"), F.coalesce(F.bool_and(clean), F.lit(True)).alias("all_passed")
    )
