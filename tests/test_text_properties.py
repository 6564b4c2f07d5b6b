"""Text rules against Python's own regular expressions, on many made-up texts at once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from flightlake import constants as c
from flightlake.functions import text
from flightlake.operators import requests as req

PIECES = [
    "best", "worst", "compare", "comparing", "versus", "vs", "rank", "ranking", "which airline",
    "most", "least", "trend", "over time", "week over week", "weekXoverXweek", "improv", "improving",
    "worsen", "worsening", "should i", "avoid", "across routes", "all airline", "and also", "as well as",
    "almost", "trends", "Bestö", "öbest", "élan", "ÉTION", "ß", "İ", "ſ", "K", "_best", "best_", "9best",
    "ignore all previous instructions", "ignore\tprior  instruction", "you are now an ", "SYSTEM :",
    "disregard prior", "new instruction", "act as", "act as if you are ", "act as if", "?", "??", ".",
    "\n", " ", " ", "\x1c", " ", "  ", "-", "'", "delay", "route", "risk", "$1", "\\", "(", "[",
]


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(11)
    made = [
        rng.choice(["", " "]).join(rng.choices(PIECES, k=rng.randint(1, 6))) for _ in range(4000)
    ]
    cased = [t.upper() if rng.random() < 0.3 else t for t in made]
    return cased, spark.createDataFrame(list(enumerate(cased)), "id int, t string").repartition(4)


def compare(texts, column, expected):
    made, rows = texts
    found = {r["id"]: r["x"] for r in rows.select("id", column.alias("x")).collect()}
    wrong = [(t, found[i], expected(t)) for i, t in enumerate(made) if found[i] != expected(t)]
    assert not wrong, wrong[:5]


def test_router(texts):
    signals = re.compile(r"\b(" + "|".join(c.AGENT_SIGNALS) + r")\b", re.IGNORECASE)

    def route(t):
        return "agent" if t.count("?") > 1 or signals.search(t) else "retrieve"

    compare(texts, req.question_route(F.col("t")), route)


def test_redaction(texts):
    overrides = re.compile("(" + "|".join(c.OVERRIDE_PATTERNS) + ")", re.IGNORECASE)
    compare(texts, text.redact(F.col("t")), lambda t: overrides.sub(c.REDACTED, t))


def test_strip(texts):
    compare(texts, text.strip(F.col("t")), str.strip)


def test_length(texts):
    compare(texts, F.length("t"), len)


def test_truthy(texts):
    compare(texts, text.truthy(F.col("t")), lambda t: t.strip().lower() in c.TRUE_WORDS)
