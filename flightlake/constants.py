"""Fixed values.

Everything in this file decides results by its exact content: field lists,
bounds, weights, patterns and texts. Logic lives elsewhere.
"""

# --- Fixed values: flight records -----------------------------------------
FLIGHT_FIELDS = [
    "flight_id",
    "airline",
    "origin",
    "destination",
    "departure_delay_min",
    "arrival_delay_min",
    "weather_flag",
    "status",
    "event_ts",
]
SILVER_KEYS = ["flight_id", "airline", "origin", "destination", "event_ts"]
REQUIRED_FIELDS = [
    "flight_id",
    "airline",
    "origin",
    "destination",
    "event_ts",
    "departure_delay_min",
    "arrival_delay_min",
    "status",
    "weather_flag",
]
DELAY_MIN = -60
DELAY_MAX = 600
SEVERE_DELAY_MIN = 60
LATE_DEPARTURE_MIN = 15
DISRUPTED_STATUSES = ["DELAYED", "CANCELLED", "DIVERTED"]

# --- Fixed values: summary tables -----------------------------------------
BY_AIRLINE = "by_airline"
BY_ROUTE = "by_route"
DELAYED_BY_DAY = "delayed_by_day"
ON_TIME_PCT = "on_time_pct"
SUMMARY_COLUMNS = [
    "summary_type",
    "dimension_key",
    "avg_dep_delay_min",
    "avg_arr_delay_min",
    "total_flights",
]
# Delay drivers, in the order their rules are tried; the last one has no rule.
RISK_WEIGHTS = {"disruption": 0.45, "severe": 0.35, "weather": 0.20}

# --- Fixed values: questions ----------------------------------------------
MAX_QUESTION_LEN = 500
DEFAULT_DAYS_BACK = 7
MAX_DAYS_BACK = 30
DEFAULT_TOP_K = 5
MAX_TOP_K = 20
SESSION_ID_PATTERN = r"^[A-Za-z0-9_\-]{1,64}$"
AIRLINE_PATTERN = r"^[A-Z0-9]{2,3}$"
ROUTE_PATTERN = r"^[A-Z]{3}-[A-Z]{3}$"
ERROR_NO_QUESTION = "Missing 'question' field"
ERROR_LONG_QUESTION = "'question' must be 500 characters or fewer"
ERROR_SESSION_ID = (
    "'session_id' must contain only letters, digits, hyphens, or underscores (max 64 chars)"
)
ERROR_AIRLINE = "'airline' must be a 2–3 character IATA code (e.g. 'AA')"
ERROR_ROUTE = "'route' must be ORIGIN-DEST with 3-letter codes (e.g. 'ATL-LAX')"
ERROR_DAYS_BACK = "'days_back' must be between 1 and 30"
ERROR_TOP_K = "'top_k' must be between 1 and 20"
ERROR_NOT_INTEGER = "'days_back' and 'top_k' must be integers"

# Words that send a question to the agent, matched between word edges.
AGENT_SIGNALS = [
    r"best",
    r"worst",
    r"compar(e|ing|ison)",
    r"versus",
    r"vs",
    r"rank(ing)?",
    r"which airline",
    r"most",
    r"least",
    r"highest",
    r"lowest",
    r"trend",
    r"over time",
    r"week.?over.?week",
    r"improv",
    r"worsen",
    r"should i",
    r"would you recommend",
    r"avoid",
    r"better alternative",
    r"across (airlines?|routes?)",
    r"all airlines?",
    r"and (also|what about)",
    r"as well as",
    r"additionally",
]
FACT_WORDS = ["risk", "disruption", "delay"]
RISK_TYPES = ["route_risk", "risk", "disruption"]
AGENT_RISK_TYPES = ["route_risk", "risk"]
AIRLINE_TYPES = ["airline", "performance", "delays"]
WEATHER_TYPES = ["weather", "impact"]
AGENT_WEATHER_TYPES = ["weather"]

# Instruction-override patterns removed from untrusted text.
OVERRIDE_PATTERNS = [
    r"ignore\s+(all\s+)?(previous|prior|above)\s+instructions?",
    r"you\s+are\s+now\s+(a|an)\s",
    r"system\s*:",
    r"disregard\s+(all\s+)?prior",
    r"new\s+instructions?",
    r"act\s+as\s+(if\s+you\s+(are|were)\s)?",
]
REDACTED = "[REDACTED]"

# --- Fixed values: retrieval ----------------------------------------------
VECTOR_DIMENSIONS = 768
LEAF_SIZE = 100
LEAVES_SEARCHED = 0.07
MIN_VECTOR_HITS = 3
CONTEXT_ROWS = 3
REFERENCE_CHARS = 500
NO_HISTORY = "(none)"
NO_DOCUMENTS = "(no vector search results)"
NO_FACTS = "(no BigQuery facts)"
NO_DATA_ANSWER = (
    "No matching data was found for the requested filters in the selected time window."
)
SOURCE_TYPE = "flight_event"
SOURCE_DOCUMENTS = "ai_rag_documents"
SOURCE_GOLD = "gold_layer"
TOOL_VECTOR = "vector_search"
TOOL_FACTS = "bigquery_fallback"
TOOL_MODEL = "gemini_2.5_flash"
METADATA_FIELDS = ["content", "source_type", "airline", "route", "event_date"]

# --- Fixed values: sessions and logs --------------------------------------
SESSION_ENTRIES = 20
SESSION_TTL_SECONDS = 3600
LOG_RETENTION_DAYS = 30
EVENT_TOKENS = "token_usage"
EVENT_GUARDRAIL = "guardrail_triggered"
EVENT_FALLBACK = "bq_fallback"
EVENT_ROUTER = "router_decision"
EXPORTED_EVENTS = ["token_usage", "guardrail_triggered", "bq_fallback"]
GUARDRAIL_EVENTS = ["guardrail_triggered", "bq_fallback"]
TRUE_WORDS = ["1", "true", "t", "yes", "y", "on"]

# --- Fixed values: evaluation ---------------------------------------------
WORKER_HEALTH = "pipeline_health"
WORKER_RISK = "risk_analyst"
WORKER_WEATHER = "weather_analyst"
WORKER_MITIGATION = "mitigation_advisor"
EXPECTED_CHAIN = ["risk_analyst", "mitigation_advisor"]
TOKENS_PER_CALL = 4000
CHAIN_CALLS = 2
DECISION_WEATHER = "monitor_weather"
DECISION_ESCALATE = "escalate_ops"
DECISION_NONE = "no_action"
WEATHER_EVENT_PCT = 30
ESCALATION_DELAY_MIN = 60
DECISION_KEYWORDS = {
    "monitor_weather": ["weather", "monitor"],
    "escalate_ops": ["escalate", "schedule", "crew", "operations"],
    "no_action": ["no action", "normal", "within"],
}
ROUTING_HEALTH_ONLY = "exactly_pipeline_health"
ROUTING_RISK_FIRST = "mitigation_after_risk"
ROUTING_WEATHER_ONLY = "no_mitigation_for_pure_weather"
ANSWER_KEYWORDS = {
    "delay_explanation": (["delay", "weather", "airline", "minute", "percent", "%"], 2),
    "route_risk": (["risk", "disruption", "delay", "percent", "%", "rate", "flight"], 3),
    "nl_analytics": (
        ["weather", "flight", "percent", "%", "count", "impact", "affected"],
        3,
    ),
}
RESPONSE_FIELDS = ["question", "answer", "context_count", "facts_count", "sources", "timestamp"]
MIN_ANSWER_CHARS = 10
