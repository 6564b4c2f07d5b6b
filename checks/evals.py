"""Checks over logged agent runs and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import sql
from flightlake.constants import ANSWER_KEYWORDS
from flightlake.operators import evals
from flightlake.operators.facts import pair_facts, recent_documents
from flightlake.session import materialise

FOUND = """
  SELECT run_id, list(author ORDER BY event_no) AS authors FROM (
    SELECT *, lag(author) OVER (PARTITION BY run_id ORDER BY event_no) AS previous
    FROM run_events) steps
  WHERE previous IS NULL OR previous <> author GROUP BY run_id"""


@query(
    "eval_trajectory",
    sql(
        "SELECT run_id, CASE WHEN authors = ['risk_analyst', 'mitigation_advisor'] THEN 'PASS' "
        f"ELSE 'FAIL' END AS trajectory FROM ({FOUND}) f"
    ),
)
def eval_trajectory(spark, sf):
    return evals.eval_trajectory(fx.run_events(spark, sf))


@query(
    "agent_transitions",
    sql(
        "SELECT run_id, event_no, author FROM (SELECT *, lag(author) OVER (PARTITION BY run_id "
        "ORDER BY event_no) AS previous FROM run_events) steps "
        "WHERE previous IS NULL OR previous <> author"
    ),
)
def agent_transitions(spark, sf):
    return evals.agent_transitions(fx.run_events(spark, sf), span=3)


@query(
    "workers_called",
    sql(
        "SELECT run_id, string_agg(author, ',' ORDER BY first_no) AS workers_called FROM ("
        "SELECT run_id, author, min(event_no) AS first_no FROM run_events GROUP BY run_id, author) f "
        "GROUP BY run_id"
    ),
)
def workers_called(spark, sf):
    called = evals.workers_called(fx.run_events(spark, sf))
    return called.withColumn("workers_called", F.array_join("workers_called", ","))


CONSTRAINT = (
    "CASE run_id % 3 WHEN 0 THEN 'exactly_pipeline_health' WHEN 1 THEN 'mitigation_after_risk' "
    "ELSE 'no_mitigation_for_pure_weather' END"
)
CALLED = """
  SELECT run_id, list(author ORDER BY first_no) AS called FROM (
    SELECT run_id, author, min(event_no) AS first_no FROM run_events GROUP BY run_id, author) firsts
  GROUP BY run_id"""


@query(
    "eval_routing",
    sql(
        f"""
        SELECT run_id, {CONSTRAINT} AS constraint, CAST(len(called) AS BIGINT) AS workers_called,
          CASE WHEN CASE run_id % 3 WHEN 0 THEN called = ['pipeline_health']
            WHEN 1 THEN list_contains(called, 'risk_analyst')
              AND list_contains(called, 'mitigation_advisor')
              AND list_position(called, 'risk_analyst')
                < list_position(called, 'mitigation_advisor')
            ELSE NOT list_contains(called, 'mitigation_advisor')
              AND list_contains(called, 'weather_analyst') END
          THEN 'PASS' ELSE 'FAIL' END AS routing
        FROM ({CALLED}) c"""
    ),
)
def eval_routing(spark, sf):
    events = fx.run_events(spark, sf)
    cases = events.select("run_id", F.expr(CONSTRAINT).alias("constraint")).distinct()
    return evals.eval_routing(cases, events)


def _pairs(spark, sf):
    """The rows that the risk tool would show for any filter."""
    return materialise(pair_facts(recent_documents(fx.document_table(spark, sf), fx.AS_OF, fx.DAYS)), "pairs")


def _runs(spark, sf, pairs):
    """One run per conversation: cases with airline and route, either, neither, and without any row.

    Two of three answers quote a number of their ground truth.
    """
    runs = (
        fx.table(spark, sf, "conversations")
        .groupBy(F.col("conv_id").alias("run_id"))
        .agg(
            (F.sum(F.length("text")) * 10).alias("total_tokens"),
            F.count("*").alias("tool_calls"),
        )
        .selectExpr(
            "run_id",
            "substring('AADLUAWNB6ASNKF9G4HAZZ', CAST(1 + 2 * (run_id % 11) AS INT), 2) AS airline",
            "CASE run_id % 3 WHEN 0 THEN 'agent' WHEN 1 THEN 'multi_agent' "
            "ELSE 'coordinate' END AS architecture",
            "concat('case ', CAST(run_id % 20 AS VARCHAR(20))) AS question",
            "total_tokens",
            "tool_calls",
        )
    )
    last = pairs.groupBy("airline").agg(F.max("route").alias("last_route"))
    kind = F.col("run_id") % 7
    runs = runs.join(last, "airline", "left").select(
        *[c for c in runs.columns if c != "airline"],
        F.when(kind < 5, F.col("airline")).alias("airline"),
        F.when(kind == 0, F.lower("last_route"))
        .when(kind == 1, "QQQ-QQQ")
        .when(kind == 2, "")
        .when(kind == 5, F.col("last_route"))
        .alias("route"),
    )
    delay, weather = (evals.one_decimal(F.col(c)) for c in ("avg_delay_min", "weather_pct"))
    answer = (
        F.when(
            F.col("run_id") % 3 == 0,
            F.concat(
                F.lit("Escalate to operations: average delay is "),
                F.coalesce(delay, F.lit("")),
                F.lit(" minutes."),
            ),
        )
        .when(
            F.col("run_id") % 3 == 1,
            F.concat(
                F.lit("Monitor the weather, share "), F.coalesce(weather, F.lit("")), F.lit("%.")
            ),
        )
        .otherwise(F.concat(F.lit("Within normal variance, run "), F.col("run_id").cast("string")))
    )
    return (
        evals.with_ground_truth(runs, pairs)
        .withColumn("answer", answer)
        .drop("avg_delay_min", "weather_pct", "has_truth")
    )


NUMBERS = """list_has_any(regexp_extract_all(r.answer, '\\d+\\.?\\d*'),
  [CAST(CAST(t.avg_delay_min AS DECIMAL(18,1)) AS VARCHAR),
   CAST(CAST(t.weather_pct AS DECIMAL(18,1)) AS VARCHAR)])"""


@query(
    "eval_grounding",
    sql(
        f"SELECT run_id, CASE WHEN {NUMBERS} THEN 'PASS' ELSE 'FAIL' END AS grounding "
        "FROM runs r JOIN truth t USING (run_id)"
    ),
)
def eval_grounding(spark, sf):
    pairs = _pairs(spark, sf)
    return evals.eval_grounding(_runs(spark, sf, pairs), pairs)


EXPECTED = """CASE WHEN t.weather_pct >= 30 THEN 'monitor_weather'
  WHEN t.avg_delay_min > 60 THEN 'escalate_ops' ELSE 'no_action' END"""


@query(
    "eval_correctness",
    sql(
        f"""
        SELECT run_id, expected, CASE WHEN EXISTS (
            SELECT 1 FROM (VALUES ('monitor_weather', 'weather'), ('monitor_weather', 'monitor'),
              ('escalate_ops', 'escalate'), ('escalate_ops', 'schedule'), ('escalate_ops', 'crew'),
              ('escalate_ops', 'operations'), ('no_action', 'no action'), ('no_action', 'normal'),
              ('no_action', 'within')) k(decision, word)
            WHERE k.decision = expected AND contains(lower(answer), k.word))
          THEN 'PASS' ELSE 'FAIL' END AS correctness
        FROM (SELECT run_id, r.answer, {EXPECTED} AS expected
              FROM runs r JOIN truth t USING (run_id)) judged"""
    ),
)
def eval_correctness(spark, sf):
    pairs = _pairs(spark, sf)
    return evals.eval_correctness(_runs(spark, sf, pairs), pairs)


BUDGET = "CASE WHEN total_tokens > 0 AND total_tokens <= 8000 THEN 'PASS' ELSE 'FAIL' END"


@query("eval_token_budget", sql(f"SELECT run_id, {BUDGET} AS token_budget FROM run_rows"))
def eval_token_budget(spark, sf):
    return evals.eval_token_budget(_runs(spark, sf, _pairs(spark, sf)))


@query(
    "eval_token_budget_calls",
    sql(
        "SELECT run_id, CASE WHEN total_tokens > 0 AND total_tokens <= 4000 * (tool_calls + 1) "
        "THEN 'PASS' ELSE 'FAIL' END AS token_budget FROM run_rows"
    ),
)
def eval_token_budget_calls(spark, sf):
    """The coordinator's ceiling grows with the workers called, plus its own call."""
    return evals.eval_token_budget(_runs(spark, sf, _pairs(spark, sf)), F.col("tool_calls") + 1)


@query(
    "eval_skipped",
    sql(
        "SELECT r.run_id, t.run_id IS NULL AS skipped "
        "FROM run_rows r LEFT JOIN truth t ON t.run_id = r.run_id"
    ),
)
def eval_skipped(spark, sf):
    pairs = _pairs(spark, sf)
    return evals.eval_skipped(_runs(spark, sf, pairs), pairs)


def _per_architecture(name: str) -> str:
    of = f"FILTER (WHERE architecture = '{name}')"
    return (
        f"CAST(sum(total_tokens) {of} AS BIGINT) AS {name}_total_tokens, "
        f"CAST(sum(tool_calls) {of} AS BIGINT) AS {name}_tool_calls"
    )


@query(
    "architecture_comparison",
    sql(
        "SELECT question, "
        + ", ".join(_per_architecture(n) for n in ("agent", "multi_agent", "coordinate"))
        + " FROM run_rows GROUP BY question"
    ),
)
def architecture_comparison(spark, sf):
    return evals.architecture_comparison(_runs(spark, sf, _pairs(spark, sf)))


def _keyword_sql(use_case: str) -> str:
    words, wanted = ANSWER_KEYWORDS[use_case]
    count = " + ".join(f"CAST(contains(lower(answer), '{w}') AS INTEGER)" for w in words)
    return (
        f"SELECT request_id, '{use_case}' AS use_case, CAST({count} AS INTEGER) AS keyword_matches, "
        f"({count}) >= {wanted} AS has_keywords FROM responses"
    )


@query("answer_keywords", sql(" UNION ALL ".join(map(_keyword_sql, ANSWER_KEYWORDS))))
def answer_keywords(spark, sf):
    answers = fx.responses(spark, sf)
    parts = [
        evals.answer_keywords(answers, name).withColumn("use_case", F.lit(name))
        for name in ANSWER_KEYWORDS
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "response_contract",
    sql(
        """
        SELECT request_id, failures, failures = 0 AS valid FROM (
          SELECT request_id, CAST(CAST(question IS NULL AS INTEGER)
            + CAST(answer IS NULL AS INTEGER) + CAST(context_count IS NULL AS INTEGER)
            + CAST(facts_count IS NULL AS INTEGER) + CAST(sources IS NULL AS INTEGER)
            + CAST(timestamp IS NULL AS INTEGER)
            + CAST(coalesce(length(answer), 0) <= 10 AS INTEGER)
            + CAST(coalesce(context_count, -1) < 0 AS INTEGER)
            + CAST(coalesce(facts_count, -1) < 0 AS INTEGER) AS INTEGER) AS failures
          FROM responses) n"""
    ),
)
def response_contract(spark, sf):
    return evals.response_contract(fx.responses(spark, sf))


@query(
    "all_checks_passed",
    sql(
        f"""
        SELECT count(*) AS runs,
          coalesce(bool_and(coalesce(grounding, 'PASS') <> 'FAIL' AND token_budget <> 'FAIL'), true)
            AS all_passed
        FROM (SELECT r.run_id, {BUDGET} AS token_budget,
                CASE WHEN t.run_id IS NULL THEN NULL WHEN {NUMBERS} THEN 'PASS' ELSE 'FAIL' END
                  AS grounding
              FROM runs r LEFT JOIN truth t ON t.run_id = r.run_id) reports"""
    ),
)
def all_checks_passed(spark, sf):
    pairs = _pairs(spark, sf)
    runs = _runs(spark, sf, pairs)
    reports = evals.eval_token_budget(runs).join(evals.eval_grounding(runs, pairs), "run_id", "left")
    return evals.all_checks_passed(reports, ["token_budget", "grounding"])
