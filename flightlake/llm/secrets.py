"""Secret scans: a trigram inverted index picks the documents a rule can match, the rule verifies them."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flightlake.llm.common import few_or_shuffled, whole_text
from flightlake.session import materialise

MOST_STRINGS = 64
HIT = "struct<kind_no:int,at:int,gap:bigint,chars:bigint,ok:boolean>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those with a shorter ``group`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0


#: The three kinds of secret. Two patterns hold their least length
#: themselves: a run that is too short has no longer run inside.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_chars=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)

Need = tuple[frozenset[str], ...]


def strings(nodes) -> set[str] | None:
    """All strings that a piece of a regex matches, in lower case, or None if there are too many."""
    found = {""}
    for op, arg in nodes:
        name = str(op)
        if name == "LITERAL":
            own = {chr(arg).lower()}
        elif name == "IN" and len(arg) <= 4 and all(str(o) == "LITERAL" for o, _ in arg):
            own = {chr(c).lower() for _, c in arg}
        elif name == "SUBPATTERN":
            own = strings(arg[-1])
        elif name == "BRANCH":
            parts = [strings(b) for b in arg[1]]
            own = None if None in parts else set().union(*parts)
        elif name in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 4:
            one = strings(arg[2])
            own = one and {
                "".join(p) for n in range(arg[0], arg[1] + 1) for p in product(sorted(one), repeat=n)
            }
        else:
            own = None
        if own is None or len(found) * len(own) > MOST_STRINGS:
            return None
        found = {a + b for a in found for b in own}
    return found


def any_of(needs: list[Need]) -> Need:
    """Alternatives of all; one that asks for more than another is dropped."""
    sets = {s for need in needs for s in need}
    return tuple(sorted((s for s in sets if not any(t < s for t in sets)), key=sorted))


def both(a: Need, b: Need) -> Need:
    return any_of([tuple(x | y for x in a for y in b)]) if len(a) * len(b) <= MOST_STRINGS else a


def trigram_need(nodes) -> Need:
    """Alternatives of which a matching text has all trigrams of one; an empty set asks for nothing."""
    need: Need = (frozenset(),)
    run = {""}

    def flushed(need: Need, run: set[str]) -> Need:
        return both(need, any_of([(frozenset(s[i : i + 3] for i in range(len(s) - 2)),) for s in run]))

    for node in nodes:
        own = strings([node])
        if own is not None and len(run) * len(own) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        need, run = flushed(need, run), {""}
        op, arg = node
        if str(op) == "SUBPATTERN":
            need = both(need, trigram_need(arg[-1]))
        elif str(op) == "BRANCH":
            need = both(need, any_of([trigram_need(b) for b in arg[1]]))
        elif str(op) in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] > 0:
            need = both(need, trigram_need(arg[2]))
    return flushed(need, run)


def rule_need(rule: Rule) -> Need | None:
    """The Boolean trigram query of a rule, or None if it has to scan fully."""
    need = trigram_need(re._parser.parse(rule.pattern))
    return None if any(not s for s in need) else need


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (trigram, doc_key) of lower-cased texts, for the trigrams that rules ask for.

    One row per trigram and document, sorted by trigram, written once; a list of
    any length spans as many files as it needs.
    """
    firsts = "".join(sorted({re.escape(t[0]) for t in trigrams}))
    any_trigram = "|".join(re.escape(t) for t in trigrams)
    pattern = f"(?=[{firsts}])(?=({any_trigram}))"
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(pattern), F.lit(1)))
    unsorted = materialise(keyed.select("doc_key", F.explode(found).alias("trigram")), "trigrams")
    return materialise(
        unsorted.repartitionByRange("trigram", "doc_key")
        .sortWithinPartitions("trigram", "doc_key"),
        "trigram-postings",
    )


def candidates(index: DataFrame, needs: dict[int, Need]) -> DataFrame:
    """(doc_key, candidate_of): documents whose posting lists meet a rule's query, with the rules' numbers."""
    held = F.col("held")

    def met(need: Need) -> Column:
        ways = [
            reduce(Column.__and__, [F.array_contains(held, t) for t in sorted(way)]) for way in need
        ]
        return reduce(Column.__or__, ways)

    wanted = F.array_compact(F.array(*[F.when(met(n), F.lit(i)) for i, n in needs.items()]))
    return (
        index.groupBy("doc_key")
        .agg(F.collect_set("trigram").alias("held"))
        .select("doc_key", wanted.alias("candidate_of"))
        .where(F.size("candidate_of") > 0)
    )


def with_candidates(docs: DataFrame, rules: tuple[Rule, ...], text_col: str) -> DataFrame:
    """All columns, the whole text as ``text``, doc_key, and the numbers of the rules to verify.

    doc_key is the running id of the rows of the scan, so ``docs`` has to be a
    table, or anything else that gives the same rows in the same partitions.
    The candidates are joined by broadcast only if a count shows them few.
    """
    keyed = docs.withColumns(
        {"text": whole_text(text_col), "doc_key": F.monotonically_increasing_id()}
    )
    needs = {i: need for i, rule in enumerate(rules) if (need := rule_need(rule)) is not None}
    always = F.array(*[F.lit(i) for i in range(len(rules)) if i not in needs]).cast("array<int>")
    if not needs:
        return keyed.withColumn("to_verify", always)
    trigrams = sorted({t for need in needs.values() for way in need for t in way})
    found = materialise(candidates(postings(keyed, trigrams), needs), "secret-candidates")
    joined = keyed.join(few_or_shuffled(found), "doc_key", "left")
    none = F.array().cast("array<int>")
    return joined.withColumn(
        "to_verify", F.concat(always, F.coalesce("candidate_of", none))
    ).drop("candidate_of")


def cut(text: Column, rule: Rule) -> Column:
    """The text as (before, match, ok) in order, ending with the rest and no match.

    Spark gives matches without places; the pieces between them give those.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    sized = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"), matches.alias("match"), sized.alias("sized")
    )
    return F.transform(
        parts,
        lambda p: F.struct(
            p["before"].alias("before"),
            p["match"].alias("match"),
            F.coalesce(F.length(p["sized"]) >= rule.min_chars, F.lit(False)).alias("ok"),
        ),
    )


def placed(parts: Column, number: int) -> Column:
    """Lengths instead of texts: what a rule's matches need to find their places."""

    def lengths(part: Column, at: Column) -> Column:
        return F.struct(
            F.lit(number).alias("kind_no"),
            at.alias("at"),
            F.length(part["before"]).cast("long").alias("gap"),
            F.length(part["match"]).cast("long").alias("chars"),
            part["ok"].alias("ok"),
        )

    return F.filter(F.transform(parts, lengths), lambda p: p["chars"].isNotNull())


def masked(parts: Column, mask: str) -> Column:
    """The text again, with the mask for every match that stands."""

    def clean(part: Column) -> Column:
        kept = F.coalesce(part["match"], F.lit(""))
        return F.concat(part["before"], F.when(part["ok"], F.lit(mask)).otherwise(kept))

    return F.array_join(F.transform(parts, clean), "")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> tuple[DataFrame, DataFrame]:
    """(found, spans): (doc_key, id_col), a row per document; and (doc_key, kind_no, kind, start, end).

    Every rule scans whole texts, those with mandatory trigrams only of documents
    that have them. Places count code points, the end is exclusive. A null text
    has no spans; repeated rows and null ids are documents of their own. Each
    span is a row, numbered through its document by a running sum, so a text
    may hold any number.
    """
    none = F.array().cast(f"array<{HIT}>")
    hits = [
        F.when(F.array_contains("to_verify", i), placed(cut(F.col("text"), rule), i)).otherwise(none)
        for i, rule in enumerate(rules)
    ]
    found = materialise(
        with_candidates(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), rules, "_text")
        .select("doc_key", F.col("_id").alias(id_col), F.concat(*hits).alias("hits")),
        "secret-hits",
    )
    earlier = Window.partitionBy("doc_key", "kind_no").orderBy("at")
    spans = (
        found.where(F.size("hits") > 0)
        .select("doc_key", F.explode("hits").alias("h"))
        .select("doc_key", "h.*")
        .repartition("doc_key")
        .withColumn("end", F.sum(F.col("gap") + F.col("chars")).over(earlier))
        .where("ok")
    )
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return found.drop("hits"), spans.select(
        "doc_key",
        "kind_no",
        kinds[F.col("kind_no")].alias("kind"),
        (F.col("end") - F.col("chars")).alias("start"),
        "end",
    )


def digest(found: DataFrame, spans: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document of ``found``: a count per kind, and its spans as text by start, then kind."""
    rows = F.sort_array(F.collect_list(F.struct("start", "kind_no", "kind", "end")))
    as_text = F.array_join(
        F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    counts = {f"n_{r.kind}": F.count_if(F.col("kind_no") == i) for i, r in enumerate(rules)}
    by_doc = spans.groupBy("doc_key").agg(
        *[c.alias(name) for name, c in counts.items()], as_text.alias("spans")
    )
    joined = found.join(by_doc, "doc_key", "left")
    return joined.withColumns(
        {name: F.coalesce(name, F.lit(0).cast("long")) for name in counts}
        | {"spans": F.coalesce("spans", F.lit(""))}
    ).drop("doc_key")


def redact(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The same rows and columns, with every secret in the text replaced by ``[kind]``.

    Rules apply in turn, each to what the one before has left. Texts without a
    secret stay as they are, a null text stays null.
    """
    held = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in held.items()])
    rows = with_candidates(renamed, rules, held[text_col])
    text = F.col("text")
    for i, rule in enumerate(rules):
        clean = masked(cut(text, rule), f"[{rule.kind}]")
        rows = rows.withColumn("text", F.when(F.array_contains("to_verify", i), clean).otherwise(text))
    text = F.when(F.col(held[text_col]).isNotNull(), F.col("text"))
    return rows.select(*[(text if c == text_col else F.col(n)).alias(c) for c, n in held.items()])
