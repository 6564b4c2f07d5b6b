"""A batch of questions: validate, route, redact, gate, assemble, answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.constants import (
    AGENT_SIGNALS,
    AIRLINE_PATTERN,
    CONTEXT_ROWS,
    DEFAULT_DAYS_BACK,
    DEFAULT_TOP_K,
    ERROR_AIRLINE,
    ERROR_DAYS_BACK,
    ERROR_LONG_QUESTION,
    ERROR_NO_QUESTION,
    ERROR_NOT_INTEGER,
    ERROR_ROUTE,
    ERROR_SESSION_ID,
    ERROR_TOP_K,
    EVENT_FALLBACK,
    EVENT_GUARDRAIL,
    EVENT_ROUTER,
    EVENT_TOKENS,
    FACT_WORDS,
    MAX_DAYS_BACK,
    MAX_QUESTION_LEN,
    MAX_TOP_K,
    MIN_VECTOR_HITS,
    NO_DATA_ANSWER,
    NO_DOCUMENTS,
    NO_FACTS,
    NO_HISTORY,
    REFERENCE_CHARS,
    ROUTE_PATTERN,
    SESSION_ID_PATTERN,
    TOOL_FACTS,
    TOOL_MODEL,
    TOOL_VECTOR,
)
from flightlake.functions.text import blank_to_null, contains_any, json_row_text, redact, strip


def normalise_requests(requests: DataFrame) -> DataFrame:
    """Trim and upper-case the request fields and fill the defaults."""
    return requests.withColumns(
        {
            "question": F.coalesce(strip(F.col("question")), F.lit("")),
            "airline": blank_to_null(F.upper("airline")),
            "route": blank_to_null(F.upper("route")),
            "session_id": blank_to_null(F.col("session_id")),
            "days_back": F.coalesce(F.col("days_back").cast("string"), F.lit(str(DEFAULT_DAYS_BACK))),
            "top_k": F.coalesce(F.col("top_k").cast("string"), F.lit(str(DEFAULT_TOP_K))),
        }
    )


def request_error() -> Column:
    """Text of the first broken rule; NULL for a valid request."""

    def misfit(name: str, pattern: str) -> Column:
        return F.col(name).isNotNull() & ~F.col(name).rlike(pattern)

    days, top_k = F.col("days_back").try_cast("int"), F.col("top_k").try_cast("int")
    rules = [
        (F.col("question") == "", ERROR_NO_QUESTION),
        (F.length("question") > MAX_QUESTION_LEN, ERROR_LONG_QUESTION),
        (misfit("session_id", SESSION_ID_PATTERN), ERROR_SESSION_ID),
        (misfit("airline", AIRLINE_PATTERN), ERROR_AIRLINE),
        (misfit("route", ROUTE_PATTERN), ERROR_ROUTE),
        (days.isNull(), ERROR_NOT_INTEGER),
        (~days.between(1, MAX_DAYS_BACK), ERROR_DAYS_BACK),
        (top_k.isNull(), ERROR_NOT_INTEGER),
        (~top_k.between(1, MAX_TOP_K), ERROR_TOP_K),
    ]
    return F.coalesce(*[F.when(broken, F.lit(text)) for broken, text in rules])


def validate_requests(requests: DataFrame) -> DataFrame:
    """Normalised requests with an ``error`` column; typed numbers where valid."""
    checked = normalise_requests(requests).withColumn("error", request_error())
    return checked.withColumns(
        {
            "days_back": F.col("days_back").try_cast("int"),
            "top_k": F.col("top_k").try_cast("int"),
        }
    )


def question_route(question: Column) -> Column:
    """``agent`` for comparing, ranking, trend or several questions, else ``retrieve``."""
    signals = r"(?iU)\b(" + "|".join(AGENT_SIGNALS) + r")\b"
    several = F.regexp_count(question, F.lit(r"\?")) > 1
    return F.when(several | question.rlike(signals), "agent").otherwise("retrieve")


def route_question(requests: DataFrame) -> DataFrame:
    return requests.withColumn("routed_to", question_route(strip(F.col("question"))))


def facts_query_type(requests: DataFrame) -> DataFrame:
    """Which facts report a question asks for."""
    text = F.lower("question")
    kind = F.when(
        contains_any(text, FACT_WORDS),
        F.when(text.contains("route"), "route_risk").otherwise("airline"),
    ).otherwise("generic")
    return requests.withColumn("query_type", kind)


def redact_instructions(rows: DataFrame, name: str = "content") -> DataFrame:
    return rows.withColumn(name, redact(F.col(name)))


def first_n(rows: DataFrame, key: str, order: str, n: int = CONTEXT_ROWS) -> DataFrame:
    """The first rows of each question, cut before the shuffle as well as after it."""
    ranked = Window.partitionBy(key).orderBy(order)
    return (
        rows.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def retrieval_gate(requests: DataFrame, matches: DataFrame) -> DataFrame:
    """Hit count per question, and whether facts must be fetched as well."""
    hits = matches.groupBy("request_id").agg(F.count("*").alias("vs_results"))
    found = F.coalesce("vs_results", F.lit(0).cast("bigint"))
    return (
        requests.join(hits, "request_id", "left")
        .withColumn("vs_results", found)
        .withColumn("needs_facts", F.col("vs_results") < MIN_VECTOR_HITS)
    )


def _ordered_text(order: str, text: Column, separator: str) -> Column:
    """Texts of a bounded group, joined in order."""
    pieces = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t"))))
    return F.array_join(F.transform(pieces, lambda piece: piece["t"]), separator)


def history_blocks(entries: DataFrame) -> DataFrame:
    """Session entries (already cut to the last ones) as one cleaned text per session."""
    speaker = F.when(F.col("role") == "user", "User").otherwise("Assistant")
    line = F.concat(speaker, F.lit(": "), redact(F.coalesce("content", F.lit(""))))
    return entries.groupBy("session_id").agg(
        _ordered_text("entry_no", line, "\n").alias("history_block")
    )


def reference_blocks(matches: DataFrame) -> DataFrame:
    """The first three matches of a question as numbered references of 500 characters."""
    kept = first_n(matches, "request_id", "match_rank")
    numbered = kept.withColumn(
        "ref_no", F.row_number().over(Window.partitionBy("request_id").orderBy("match_rank"))
    )
    text = F.concat(
        F.lit("[Ref "), F.col("ref_no").cast("string"), F.lit("] "), F.col("source_type"),
        F.lit(" — "), F.col("airline"), F.lit(" "), F.col("route"),
        F.lit(" ("), F.col("event_date"), F.lit(")\n"),
        F.substring(redact(F.col("content")), 1, REFERENCE_CHARS),
    )
    return numbered.groupBy("request_id").agg(
        _ordered_text("ref_no", text, "\n\n").alias("docs_block")
    )


def fact_texts(facts: DataFrame, names: list[str]) -> DataFrame:
    """Fact rows with their indented JSON text."""
    return facts.withColumn("fact_json", json_row_text(names))


def fact_blocks(facts: DataFrame) -> DataFrame:
    """The first three facts of a question, cleaned, one JSON text after another."""
    return (
        first_n(facts, "request_id", "fact_rank")
        .groupBy("request_id")
        .agg(_ordered_text("fact_rank", redact(F.col("fact_json")), "\n").alias("facts_block"))
    )


def with_session(requests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Requests beside the row of their session, if they have one.

    Requests without a session match nothing; a join key of their own keeps them
    from meeting in one task.
    """
    key = F.coalesce("session_id", F.concat(F.lit("without "), F.col("request_id").cast("string")))
    found = sessions.withColumnRenamed("session_id", "_session")
    return (
        requests.withColumn("_key", F.struct(F.col("session_id").isNotNull().alias("known"), key.alias("id")))
        .join(
            found.withColumn(
                "_key", F.struct(F.col("_session").isNotNull().alias("known"), F.col("_session").alias("id"))
            ),
            "_key",
            "left",
        )
        .drop("_key", "_session")
    )


def assemble_context(
    requests: DataFrame, entries: DataFrame, matches: DataFrame, facts: DataFrame
) -> DataFrame:
    """Per question: history, references and facts, or a fixed text where there are none."""
    joined = (
        with_session(requests.select("request_id", "session_id", "question"), history_blocks(entries))
        .join(reference_blocks(matches), "request_id", "left")
        .join(fact_blocks(facts), "request_id", "left")
    )
    return joined.select(
        "request_id",
        "question",
        F.coalesce("history_block", F.lit(NO_HISTORY)).alias("history_block"),
        F.coalesce("docs_block", F.lit(NO_DOCUMENTS)).alias("docs_block"),
        F.coalesce("facts_block", F.lit(NO_FACTS)).alias("facts_block"),
    )


def citations(matches: DataFrame) -> DataFrame:
    """The matches of a question as an ordered list of citations (at most 20)."""
    cited = F.struct(
        "match_rank",
        "doc_id",
        "source_type",
        "airline",
        "route",
        "event_date",
        F.col("distance").alias("similarity"),
    )
    ordered = F.sort_array(F.collect_list(cited))
    listed = F.transform(
        ordered,
        lambda c: F.struct(
            c["doc_id"].alias("doc_id"),
            c["source_type"].alias("source_type"),
            c["airline"].alias("airline"),
            c["route"].alias("route"),
            c["event_date"].alias("event_date"),
            c["similarity"].alias("similarity"),
        ),
    )
    kept = first_n(matches, "request_id", "match_rank", MAX_TOP_K)
    return kept.groupBy("request_id").agg(listed.alias("sources"))


def tools_used(rows: DataFrame) -> DataFrame:
    """Names of the sources that contributed to an answer."""
    labels = F.array(
        F.when(F.col("context_count") > 0, TOOL_VECTOR),
        F.when(F.col("facts_count") > 0, TOOL_FACTS),
        F.lit(TOOL_MODEL),
    )
    return rows.withColumn("tools_used", F.array_compact(labels))


def first_fact(facts: DataFrame) -> DataFrame:
    return first_n(facts, "request_id", "fact_rank", 1)


def fact_pairs(names: list[str]) -> Column:
    """``name=value`` pairs of a fact row; an absent value prints as None."""
    shown = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), F.lit("None")))
        for name in names
    ]
    return F.concat_ws(", ", *shown)


def with_fact_pairs(facts: DataFrame, names: list[str]) -> DataFrame:
    return facts.withColumn("fact_pairs", fact_pairs(names))


def fallback_answer(requests: DataFrame, facts: DataFrame) -> DataFrame:
    """A fixed-form answer from each question's first fact."""
    top = first_fact(facts).select("request_id", "fact_pairs")
    text = F.when(F.col("fact_pairs").isNull(), NO_DATA_ANSWER).otherwise(
        F.concat(
            F.lit("Deterministic response for '"), F.col("question"),
            F.lit("': "), F.col("fact_pairs"), F.lit("."),
        )
    )
    return (
        requests.join(top, "request_id", "left").withColumn("answer", text).drop("fact_pairs")
    )


def answered_entries(answers: DataFrame) -> DataFrame:
    """The two session entries of each answered request that belongs to a session.

    ``answers`` carries ``turn_no`` (how many questions the session had before),
    ``asked_at`` and the token counts, which are booked on the answer.
    """
    tokens = ["prompt_tokens", "response_tokens", "total_tokens"]

    def entry(offset: int, role: str, text: str) -> Column:
        booked = [
            (F.col(name) if role == "assistant" else F.lit(None)).cast("bigint").alias(name)
            for name in tokens
        ]
        return F.struct(
            (F.col("turn_no") * 2 + offset).cast("bigint").alias("entry_no"),
            F.col("asked_at").alias("entry_ts"),
            F.lit(role).alias("role"),
            F.col(text).alias("content"),
            *booked,
        )

    turns = F.array(entry(0, "user", "question"), entry(1, "assistant", "answer"))
    return answers.where(F.col("session_id").isNotNull()).select(
        "session_id", F.inline(turns)
    )


def request_log(
    checked: DataFrame, gated: DataFrame, answers: DataFrame | None = None
) -> DataFrame:
    """Log rows of a request batch: routing, rejections, sparse searches and tokens used.

    ``checked`` comes from ``validate_requests`` and ``gated`` from
    ``retrieval_gate``; both carry ``asked_at``. ``answers`` has the token counts
    of the answered requests and the endpoint that answered.
    """
    session = F.coalesce("session_id", F.lit("anonymous")).alias("session_id")

    def rows(source: DataFrame, severity: str, event: str, **fields: Column) -> DataFrame:
        kinds = {
            "guardrail_type": "string",
            "reason": "string",
            "vs_results": "bigint",
            "route": "string",
            "question_length": "bigint",
            "endpoint": "string",
            "prompt_tokens": "bigint",
            "response_tokens": "bigint",
            "total_tokens": "bigint",
        }
        extra = [
            fields.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in kinds.items()
        ]
        return source.select(
            F.col("asked_at").alias("log_ts"),
            F.lit(severity).alias("severity"),
            F.lit(event).alias("event"),
            session,
            *extra,
        )

    routed = rows(
        checked,
        "INFO",
        EVENT_ROUTER,
        route=question_route(F.col("question")),
        question_length=F.length("question"),
    )
    rejected = rows(
        checked.where(F.col("error").isNotNull()),
        "WARNING",
        EVENT_GUARDRAIL,
        guardrail_type=F.lit("input_validation"),
        reason=F.col("error"),
    )
    sparse = rows(
        gated.where("needs_facts"), "INFO", EVENT_FALLBACK, vs_results=F.col("vs_results")
    )
    log = routed.unionByName(rejected).unionByName(sparse)
    if answers is None:
        return log
    fields = ("endpoint", "prompt_tokens", "response_tokens", "total_tokens")
    used = rows(answers, "INFO", EVENT_TOKENS, **{name: F.col(name) for name in fields})
    return log.unionByName(used)
