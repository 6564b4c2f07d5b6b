"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flightlake.llm.common import WORD, fresh, whole_text
from flightlake.session import materialise

BUCKET_BITS = 12


@dataclass
class Mix:
    """docs: a row per document; sources: a row per source; quotas: blocks per source and shard."""

    docs: DataFrame
    sources: DataFrame
    quotas: DataFrame


def targets(totals: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Adds number, weight and target to (source, total): shares by weight under a ceiling.

    Sources are numbered by code point, null last, and take the weights in turn.
    Sharing again what a ceiling cuts off ends where every source has the smaller
    of its ceiling and its weight times one common level. With the sources in
    the order in which they reach their ceiling, the level after capping the
    first j rises until it is the right one and falls from there, so it is the
    largest. One row per source is all that meets in a task here.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = (
        totals.withColumn("number", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, ((F.col("number") - 1) % len(weights) + 1).cast("int")))
        .withColumn("ceiling", F.col("total") * F.lit(float(cap)))
        .withColumn("budget", F.sum("total").over(everything) * F.lit(float(share)))
    )
    full_first = Window.orderBy(F.col("ceiling") / F.col("weight"), "number")
    earlier = full_first.rowsBetween(Window.unboundedPreceding, -1)
    onward = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("budget") - F.coalesce(F.sum("ceiling").over(earlier), F.lit(0.0))) / F.sum(
        "weight"
    ).over(onward)
    return (
        rows.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .withColumn("target", F.least("ceiling", F.col("level") * F.col("weight")))
        .drop("level")
    )


def apportion(sources: DataFrame, shards: int) -> DataFrame:
    """(number, shard, first, quota): blocks of each source in each shard, by highest quotients.

    The first j shards together get their part of all seats, each seat going to
    the source with the highest target / (2 * seats so far + 1). Such a row of
    apportionments only ever grows, so the differences are the shards' quotas.
    Seats that a source is sure of are counted by division; only the last ones,
    about two for each source, compete as rows. A source gets no more seats than
    its blocks hold at the mix's ceiling.
    """
    seats, sure = F.col("upto"), F.col("n_sources")
    entries = sources.where("target > 0 AND blocks > 0").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    entries = (
        entries.withColumn("upto", F.floor(F.col("seats") * (F.col("shard") + 1) / shards))
        .withColumn(
            "base",
            F.least(
                "most",
                F.greatest(
                    F.lit(0),
                    F.floor(F.col("target") * (2 * seats - sure) / (2 * F.col("budget")) + 0.5) - 1,
                ),
            ).cast("long"),
        )
        .withColumn(
            "top",
            F.least(
                F.col("most"),
                F.ceil(F.col("target") * (2 * seats + sure) / (2 * F.col("budget")) + 0.5) + 1,
            ).cast("long"),
        )
    )
    per_shard = Window.partitionBy("shard")
    entries = entries.withColumn("free", seats - F.sum("base").over(per_shard))
    contest = entries.where("top > base").withColumn(
        "held", F.explode(F.sequence("base", F.col("top") - 1))
    )
    rank = Window.partitionBy("shard").orderBy(
        (F.col("target") / (2 * F.col("held") + 1)).desc(), "number"
    )
    won = (
        contest.withColumn("rank", F.row_number().over(rank))
        .where("rank <= free")
        .groupBy("number", "shard")
        .agg(F.count(F.lit(1)).alias("won"))
    )
    so_far = Window.partitionBy("number").orderBy("shard")
    return (
        entries.select("number", "shard", "base")
        .join(won, ["number", "shard"], "left")
        .withColumn("upto", F.col("base") + F.coalesce("won", F.lit(0)))
        .withColumn("first", F.coalesce(F.lag("upto").over(so_far), F.lit(0)))
        .select("number", "shard", "first", (F.col("upto") - F.col("first")).alias("quota"))
    )


def chosen_before(block: Column) -> Column:
    """How many of a source's blocks before this one are chosen once more than all are.

    The ``extra`` chosen ones follow each other from a seeded start, past the last
    block on to the first; the documents' order being seeded too, that is a random
    choice that cuts next to no document.
    """
    end = F.col("start") + F.col("extra")
    straight = F.least(block, end, F.col("blocks")) - F.col("start")
    return F.greatest(F.lit(0), straight) + F.least(block, F.greatest(F.lit(0), end - F.col("blocks")))


def document_runs() -> Column:
    """(first_word, n_words) of every run of words that the mix takes of a document: whole copies, then parts."""
    begin, end = F.col("from_word"), F.col("from_word") + F.col("size")
    arc_end = F.col("start") + F.col("extra")
    arcs = [
        (F.col("start"), F.least(arc_end, F.col("blocks"))),
        (F.lit(0), F.greatest(F.lit(0), arc_end - F.col("blocks"))),
    ]

    def run(first: Column, n: Column) -> Column:
        return F.struct(first.cast("long").alias("first_word"), n.cast("long").alias("n_words"))

    parts = []
    for first, last in arcs:
        low = F.greatest(begin, first * F.col("block_words"))
        high = F.least(end, last * F.col("block_words"))
        parts.append(run(low - begin, F.greatest(F.lit(0), high - low)))
    whole = F.array_repeat(run(F.lit(0), F.col("size")), F.col("copies").cast("int"))
    return F.filter(F.concat(whole, F.array(*parts)), lambda r: r["n_words"] > 0)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    most_block_words: int = 1024,
    shards: int = 16,
    seed: int = 1,
    keep: tuple[str, ...] = (),
) -> Mix:
    """How many words of each document a mix of the sources takes.

    A document's size is its number of words. A source's documents, in an order
    seeded by id and text, are one stream of words cut into blocks of equal
    length (at most ``most_block_words``, and a thousandth of the smallest source
    that has words). Blocks go to sources, shard by shard, by Sainte-Laguë
    (:func:`apportion`); a source's seats take every block ``copies`` times and
    a seeded choice of them once more. As the choice is a formula of the block
    number, a document's words are found without a row per block.

    Columns of ``docs`` in the result: id_col, those named in ``keep``, source,
    size, source_size, target, taken, the stream place ``from_word`` and ``runs``,
    the words taken as (first_word, n_words) runs, repeats included. Null
    texts have size 0, a null source is a source of its own, null ids are kept;
    equal rows are interchangeable and share out their places. Sources without
    words get target 0; an empty table gives none. The same rows give the same
    mix, whatever their partitioning. A source of any size is split into
    ``2**BUCKET_BITS`` ranges of its order before its running sums.
    """
    text = whole_text(text_col)
    sized = materialise(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), text).alias("place"),
            *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)],
        ).withColumn("bucket", F.shiftright("place", 64 - BUCKET_BITS)),
        "mix-sizes",
    )
    buckets = materialise(
        sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets"
    )
    shared = targets(
        buckets.groupBy("source").agg(F.sum("bucket_size").alias("total")), weights, share, cap
    )
    everything = Window.partitionBy()
    least = F.min(F.when(F.col("total") > 0, F.col("total"))).over(everything)
    shared = (
        shared.withColumn("n_sources", F.sum((F.col("target") > 0).cast("long")).over(everything))
        .withColumn(
            "block_words",
            F.greatest(F.lit(1), F.least(F.lit(most_block_words), F.floor(least / 1000))).cast("long"),
        )
        .withColumn("blocks", F.ceil(F.col("total") / F.col("block_words")).cast("long"))
        .withColumn("most", F.floor(F.col("blocks") * F.lit(float(cap))).cast("long"))
        .withColumn("seats", F.round(F.col("budget") / F.col("block_words")).cast("long"))
    )
    shared = materialise(shared, "mix-targets")
    quotas = materialise(apportion(shared, shards), "mix-quotas")
    sources = shared.join(
        quotas.groupBy("number").agg(F.sum("quota").alias("quota")), "number", "left"
    ).select(
        "number",
        "source",
        "total",
        "weight",
        "target",
        "block_words",
        "blocks",
        F.coalesce("quota", F.lit(0)).alias("quota"),
    )
    whole = F.greatest("blocks", F.lit(1))
    sources = (
        sources.withColumn("blocks", whole)
        .withColumn("copies", F.expr("quota div blocks"))
        .withColumn("extra", F.expr("quota % blocks"))
        .withColumn("start", F.pmod(F.xxhash64(F.lit(seed), "source"), F.col("blocks")))
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    places = buckets.withColumn("bucket_from", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)))
    places = places.alias("p").join(
        sources.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))
    ).select("p.*", *[f"s.{c}" for c in sources.columns if c != "source"])
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("place", "_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = sized.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    found = (
        ordered.alias("d")
        .join(
            places.alias("p"),
            F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.bucket") == F.col("p.bucket")),
        )
        .withColumn("from_word", F.col("bucket_from") + F.col("within"))
    )
    docs_out = found.select(
        F.col("_id").alias(id_col),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
        F.col("d.source").alias("source"),
        "size",
        F.col("total").alias("source_size"),
        "target",
        "from_word",
        document_runs().alias("runs"),
    ).withColumn(
        "taken", F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["n_words"])
    )
    return Mix(docs_out, sources, quotas)


def mixed_texts(docs: DataFrame, mix: Mix, key: str, text_col: str) -> DataFrame:
    """The mix as documents: a row of ``docs`` per run, its text cut to the run's words.

    key: a unique column of ``docs`` that the mix has kept. White space between a
    run's words stays; a whole copy keeps its text as it is.
    """
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    size, runs, run = (fresh(docs, name) for name in ("_size", "_runs", "_run"))
    first, n = F.col(run)["first_word"] + 1, F.col(run)["n_words"]
    part = F.array_join(F.slice(words, first.cast("int"), n.cast("int")), "")
    taken = mix.docs.where(F.size("runs") > 0).select(
        F.col(key), F.col("size").alias(size), F.col("runs").alias(runs)
    )
    return (
        docs.join(taken, key)
        .withColumn(run, F.explode(runs))
        .withColumn(text_col, F.when(n == F.col(size), F.col(text_col)).otherwise(F.ltrim(part)))
        .select(docs.columns)
    )


def shard_words(mix: Mix, key: str) -> DataFrame:
    """The rows of ``mix.docs`` with ``shard_words``: the words that each shard's quota takes of the document.

    key: a unique column that the mix has kept. An entry per shard, 0 where it takes
    none; their sum is ``taken``.
    """
    shards = mix.quotas.select(F.max("shard") + 1).scalar()
    per_shard = mixed_blocks(mix).groupBy(key, "shard").agg(F.sum("n_words").alias("n"))
    told = per_shard.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("held"))
    rows = mix.docs.join(told, key, "left").withColumn("upto", F.coalesce(shards, F.lit(0)) - 1)
    filled = F.transform(
        F.when(F.col("upto") >= 0, F.sequence(F.lit(0), "upto")).otherwise(F.array().cast("array<int>")),
        lambda s: F.coalesce(F.try_element_at("held", s), F.lit(0).cast("long")),
    )
    return rows.withColumn("shard_words", filled).drop("held", "upto")


def mixed_blocks(mix: Mix) -> DataFrame:
    """The mix itself: a row per run of words that a shard takes from a document.

    (all columns of ``mix.docs``, shard, seat, first_word, n_words): words
    first_word to first_word + n_words - 1 of the document, counted from 0; seats
    run from 0 in each source. Documents of which nothing is taken have no row.
    """
    sources = mix.sources.select(
        *[F.col(c).alias(c) for c in ("number", "source", "block_words", "blocks", "copies", "extra", "start")]
    )
    rows = (
        mix.docs.where("taken > 0")
        .alias("d")
        .join(sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
        .drop(F.col("s.source"))
    )
    first, last = (
        F.floor(F.col("from_word") / F.col("block_words")),
        F.floor((F.col("from_word") + F.col("size") - 1) / F.col("block_words")),
    )
    rows = rows.withColumn("block", F.explode(F.sequence(first, last)))
    rows = rows.withColumn("more", chosen_before(F.col("block") + 1) - chosen_before(F.col("block")))
    seats = F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("copies") + F.col("more")),
        lambda c: F.when(c <= F.col("copies"), (c - 1) * F.col("blocks") + F.col("block")).otherwise(
            F.col("copies") * F.col("blocks") + chosen_before(F.col("block"))
        ),
    )
    rows = rows.where("copies + more > 0").withColumn("seat", F.explode(seats))
    begin = F.greatest(F.lit(0), F.col("block") * F.col("block_words") - F.col("from_word"))
    end = F.least("size", (F.col("block") + 1) * F.col("block_words") - F.col("from_word"))
    rows = rows.withColumn("first_word", begin).withColumn("n_words", end - F.col("first_word"))
    taken_by = F.col("seat").between(F.col("q.first"), F.col("q.first") + F.col("q.quota") - 1)
    return (
        rows.alias("r")
        .join(mix.quotas.alias("q"), (F.col("r.number") == F.col("q.number")) & taken_by)
        .select(*[f"r.{c}" for c in mix.docs.columns], "q.shard", "r.seat", "r.first_word", "r.n_words")
    )
