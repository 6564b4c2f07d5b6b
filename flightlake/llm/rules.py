"""Quality rules: exact text measures, and a short-circuit cascade ordered by rejection per cost."""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import SPACES, WORD, bind, fresh, whole_text
from flightlake.session import materialise

WINDOW_WORDS = 8
SYMBOLS = r"[#*$%&|<>]"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def repeat_words(words: Column, width: int = WINDOW_WORDS) -> Column:
    """Words that lie in a window of ``width`` words found twice or more, first place included.

    Windows are compared by a 64-bit hash of their words. Sorted with their
    places, equal windows are neighbours; the covered words are the sum of each
    repeated window's step to the next one, ``width`` at most.
    """

    def covered(at: Column) -> Column:
        def step(i):
            return F.when(i == F.size(at), F.lit(width)).otherwise(
                F.least(F.lit(width), F.element_at(at, i + 1) - F.element_at(at, i))
            )

        return F.when(F.size(at) == 0, F.lit(0)).otherwise(
            F.aggregate(F.sequence(F.lit(1), F.size(at)), F.lit(0), lambda n, i: n + step(i))
        )

    def repeated(rows: Column) -> Column:
        def same(i, j):
            return F.element_at(rows, i)["h"] == F.element_at(rows, j)["h"]

        last = F.size(rows)
        places = F.filter(
            F.sequence(F.lit(1), last),
            lambda i: F.when((i > 1) & same(F.greatest(i - 1, F.lit(1)), i), True).otherwise(
                (i < last) & same(F.least(i + 1, last), i)
            ),
        )
        return bind(F.sort_array(F.transform(places, lambda i: F.element_at(rows, i)["i"])), covered)

    def of(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(1), F.size(w) - (width - 1)),
            lambda i: F.struct(
                F.xxhash64(*[F.element_at(w, i + k) for k in range(width)]).alias("h"), i.alias("i")
            ),
        )
        return F.when(F.size(w) > width, bind(F.sort_array(hashes), repeated)).otherwise(F.lit(0))

    return bind(words, of).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    return bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    Whole texts are measured, however long; a null text has no words and fails.
    Columns of these names are replaced, all others and repeated rows stay.
    """
    text = whole_text(text_col)
    words = words_of(text)
    found = bind(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    held = fresh(docs, "_measures")
    return (
        docs.withColumn(held, found)
        .withColumns(
            {
                "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
                "n_dup_lines": duplicate_lines(text),
                **{c: F.col(f"{held}.{c}") for c in ("n_words", "word_chars", "n_repeat_words")},
            }
        )
        .drop(held)
        .withColumn(
            "base_failed",
            (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        )
    )


@dataclass(frozen=True)
class Rule:
    """``rejects`` is true for a row to drop; a null verdict doesn't drop."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float


def adjacent_repeats(words: Column) -> Column:
    """Words equal to the word before them."""
    return bind(
        words,
        lambda w: F.when(
            F.size(w) > 1,
            F.aggregate(
                F.sequence(F.lit(2), F.size(w)),
                F.lit(0),
                lambda n, i: n + (F.element_at(w, i) == F.element_at(w, i - 1)).cast("int"),
            ),
        ).otherwise(F.lit(0)),
    )


def shouted_words(text: Column) -> Column:
    """Words with two capitals next to each other and ``!!`` behind them; a word counts once.

    What a word holds from its first two capitals on is taken in one pass, so a
    long run of capitals costs its length.
    """
    tails = F.regexp_extract_all(text, F.lit(r"\p{Lu}{2}[^\x20\x09-\x0D]*"), F.lit(0))
    return F.size(F.filter(tails, lambda tail: F.contains(tail, F.lit("!!"))))


def document_rules(text_col: str = "text") -> list[Rule]:
    """Rules over the columns that :func:`measures` adds, and over the text where they need more."""
    n_words = F.greatest(F.col("n_words"), F.lit(1))
    text = whole_text(text_col)
    return [
        Rule("word_length", ~(F.col("word_chars") / n_words).between(2, 15)),
        Rule("symbols", F.col("n_symbols") > 0.1 * n_words),
        Rule("duplicate_lines", F.col("n_dup_lines") > 0.3 * F.size(F.split(text, "\n", -1))),
        Rule("shouting", shouted_words(text) > 0.2 * n_words),
        Rule("same_word_again", adjacent_repeats(words_of(text)) > 0.2 * n_words),
    ]


def estimate(
    rows: DataFrame, rules: list[Rule], fraction: float, seed: int = 1, passes: int = 3
) -> list[Estimate]:
    """Each rule's seconds and share of rejected rows, on one seeded sample of the rows.

    The sample is stored, so that what made the rows isn't timed. Rules take turns,
    ``passes`` times; a rule's seconds are its fastest scan less the fastest
    without a rule.
    """
    sample = materialise(rows.sample(fraction, seed), "rules-sample")

    def run(*columns: Column) -> tuple[float, list]:
        began = time.perf_counter()
        found = sample.agg(F.count(F.lit(1)), *columns).first()
        return time.perf_counter() - began, found

    run()
    bare, n, seconds, rejected = math.inf, 0, {}, {}
    for _ in range(passes):
        took, (n,) = run()
        bare = min(bare, took)
        for rule in rules:
            took, (_, rejected[rule.name]) = run(F.count_if(F.coalesce(rule.rejects, F.lit(False))))
            seconds[rule.name] = min(took, seconds.get(rule.name, math.inf))
    return [
        Estimate(r.name, max(1e-3, seconds[r.name] - bare), rejected[r.name] / max(1, n)) for r in rules
    ]


def in_order(rules: list[Rule], estimates: list[Estimate]) -> list[Rule]:
    """Highest rejection per cost first; a tie goes to the cheaper rule, then to the name."""
    rank = {e.name: (-e.rejected / e.seconds, e.seconds, e.name) for e in estimates}
    return sorted(rules, key=lambda r: rank[r.name])


def cascade(
    rows: DataFrame, rules: list[Rule], estimates: list[Estimate], rejected: Column | None = None
) -> DataFrame:
    """Adds ``kept``: neither ``rejected``, if given, nor a rule rejects the row.

    The rules are one conditional in the order of :func:`in_order`, so a rule is
    evaluated only for rows that every test before it passes; ``rejected``, which
    is known already, comes first. The order never changes the verdict.
    """
    kept = F.lit(True)
    for rule in reversed(in_order(rules, estimates)):
        kept = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(False)).otherwise(kept)
    if rejected is not None:
        kept = F.when(F.coalesce(rejected, F.lit(False)), F.lit(False)).otherwise(kept)
    return rows.withColumn("kept", kept)
