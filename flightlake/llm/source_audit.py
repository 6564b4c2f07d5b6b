"""How far the sources of a language differ in their words: exact counts through minimal perfect hashes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.llm.common import few_or_shuffled
from flightlake.session import materialise

#: A term is a run of letters and non-ASCII characters, A-Z lower-cased; all else parts terms.
LETTERS = bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
FOLDED = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b in LETTERS else 0x20 for b in range(256))
LEAST_DOCS = 30
SCALE_STEPS = (1000, 1000, 1000)
SMOOTHING = 5
TOP_TERMS = 50
#: Keys of one perfect hash where a language has few sources, and cells of a task's dense counts or shares.
SHARD_KEYS = 512
CELLS = 1 << 21
#: Keys sent to the tasks at once (some 30 bytes each); more take further rounds over the documents.
MOST_KEYS = 2_000_000
#: Bytes of text and distinct terms that a task holds before it hands them on.
PIECE = 4 << 20
HELD_TERMS = 400_000


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a whole UTF-8 text, a piece of it at a time."""
    folded = text.translate(FOLDED)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def term_hash(keys: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each key, the same in every process."""
    return pd.util.hash_array(np.array(keys, dtype=object), categorize=False) if keys else np.zeros(0, np.uint64)


def spread(hashes: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The place below ``sizes`` that a seed gives to a hash; another seed moves two hashes independently."""
    x = hashes + np.asarray(seeds).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.asarray(sizes).astype(np.uint64)).astype(np.int64)


def fitting(slots: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The rows of ``slots`` that are all free and different."""
    ordered = np.sort(slots, axis=1)
    return np.flatnonzero((owner[slots] < 0).all(1) & (ordered[:, 1:] != ordered[:, :-1]).all(1))


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed per bucket, index of the hash in each slot) of distinct hashes: as many slots as hashes.

    Hashes are dealt to buckets of about four. The largest buckets come first;
    each takes the first seed that puts all its hashes on free slots. A hash alone
    in its bucket takes any slot left, and its seed says which: -1 - slot.
    """
    n = len(hashes)
    buckets = n // 4 + 1
    seeds, owner = np.zeros(buckets, np.int32), np.full(n, -1, np.int64)
    place = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(place[order])) + 1) if n else []
    groups.sort(key=len, reverse=True)
    size = np.array(max(n, 1))
    for group in groups:
        if len(group) == 1:
            break
        tried = np.arange(64)
        while not len(good := fitting(slots := spread(hashes[group], tried[:, None], size), owner)):
            tried += len(tried)
        owner[slots[good[0]]] = group
        seeds[place[group[0]]] = tried[good[0]]
    alone = [g[0] for g in groups if len(g) == 1]
    for slot, i in zip(np.flatnonzero(owner < 0).tolist(), alone, strict=True):
        owner[slot] = i
        seeds[place[i]] = -1 - slot
    return seeds, owner


SHARD = "lang string, shard int, shards int, seeds array<int>, spare int, terms array<binary>"


def build_shard(rows: pa.Table) -> pa.Table:
    """One language's shard: its terms in slot order; those whose hash another term has come last."""
    keys = sorted(rows["term"].to_pylist())
    hashes = term_hash(keys)
    _, first = np.unique(hashes, return_index=True)
    seeds, owner = perfect_hash(hashes[first])
    spare = sorted(set(range(len(keys))) - set(first.tolist()))
    placed = [keys[i] for i in first[owner]] + [keys[i] for i in spare]
    return pa.table(
        {
            "lang": rows["lang"][:1],
            "shard": rows["shard"][:1],
            "shards": rows["shards"][:1],
            "seeds": pa.array([seeds.tolist()], pa.list_(pa.int32())),
            "spare": pa.array([len(spare)], pa.int32()),
            "terms": pa.array([placed], pa.list_(pa.binary())),
        }
    )


class TermTable:
    """Perfect hashes of many shards, sorted by (lang, shard): one run of slots per language."""

    def __init__(self, rows: pa.Table):
        self.shard = np.array(rows["shard"].to_pylist(), np.int64)
        sizes = np.array(pc.list_value_length(rows["terms"]).to_pylist(), np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.hashed = sizes - np.array(rows["spare"].to_pylist(), np.int64)
        self.buckets = np.array(pc.list_value_length(rows["seeds"]).to_pylist(), np.int64)
        self.first_bucket = np.concatenate([[0], np.cumsum(self.buckets)])
        self.seeds = pc.list_flatten(rows["seeds"]).to_numpy().astype(np.int64)
        self.terms = pc.list_flatten(rows["terms"]).combine_chunks()
        self.rows: dict[str, np.ndarray] = {}
        for i, (lang, shards) in enumerate(zip(rows["lang"].to_pylist(), rows["shards"].to_pylist(), strict=True)):
            self.rows.setdefault(lang, np.full(shards, -1, np.int64))[self.shard[i]] = i
        self.spare = {}
        for i in np.flatnonzero(self.hashed < sizes).tolist():
            for at in range(self.start[i] + self.hashed[i], self.start[i + 1]):
                self.spare[rows["lang"][i].as_py(), self.terms[at].as_py()] = at

    def run(self, lang: str) -> tuple[int, int]:
        """The language's first slot here and the one after its last."""
        held = self.rows[lang][self.rows[lang] >= 0]
        return int(self.start[held.min()]), int(self.start[held.max() + 1])

    def slots(self, lang: str, keys: list[bytes]) -> np.ndarray:
        """Each term's slot, -1 for a term that is not here: the key stored in the slot has to be equal."""
        hashes = term_hash(keys)
        row = self.rows[lang][shard_of(hashes, len(self.rows[lang]))]
        here = np.flatnonzero(row >= 0)
        row, hashes = row[here], hashes[here]
        bucket = (hashes % self.buckets[row].astype(np.uint64)).astype(np.int64)
        seed = self.seeds[self.first_bucket[row] + bucket]
        slot = np.where(seed < 0, -1 - seed, spread(hashes, np.maximum(seed, 0), self.hashed[row]))
        found = self.start[row] + slot
        asked = pa.array(keys, pa.binary()).take(pa.array(here))
        same = pc.equal(self.terms.take(pa.array(found)), asked).to_numpy(zero_copy_only=False)
        out = np.full(len(keys), -1, np.int64)
        out[here[same]] = found[same]
        if self.spare:
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.spare.get((lang, keys[i]), -1)
        return out


def shard_of(hashes: np.ndarray, shards: int | np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.asarray(shards).astype(np.uint64)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> DataFrame:
    """(lang, term, n): in how many documents a term occurs; partial sums that Spark adds up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def told():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(counts), pa.string()),
                        pa.array(counts.keys(), pa.binary()),
                        pa.array(counts.values(), pa.int64()),
                    ],
                    names=["lang", "term", "n"],
                )
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                found: set[bytes] = set()
                for piece in terms(text.as_py()):
                    found.update(piece)
                held.setdefault(lang, Counter()).update(found)
                if sum(map(len, held.values())) > HELD_TERMS:
                    yield from told()
        yield from told()

    partial = docs.select("lang", "text").mapInArrow(run, "lang string, term binary, n long")
    return partial.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def kept_shards(docs: DataFrame, least_docs: int, most_sources: int) -> DataFrame:
    """Perfect hashes of the terms that a language keeps, a row per shard (``SHARD``)."""
    kept = materialise(
        document_frequencies(docs).where(F.col("n") >= least_docs).select("lang", "term"), "audit-terms"
    )
    size = max(1, min(max(SHARD_KEYS, most_sources), CELLS // max(1, most_sources)))
    sizes = kept.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("shards"))
    sized = kept.join(few_or_shuffled(materialise(sizes, "audit-sizes")), "lang")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = batch.column("shards").to_numpy()
            shard = shard_of(term_hash(batch.column("term").to_pylist()), shards)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("lang", "term", "shards")), pa.array(shard, pa.int32())],
                names=["lang", "term", "shards", "shard"],
            )

    placed = sized.select("lang", "term", "shards").mapInArrow(place, "lang string, term binary, shards int, shard int")
    return materialise(placed.groupBy("lang", "shard").applyInArrow(build_shard, SHARD), "audit-shards")


def slot_counts(docs: DataFrame, shards: DataFrame, most_keys: int) -> DataFrame:
    """(lang, source, shard, slot, n): the second pass, in as many rounds as the keys need.

    A round's shards hold at most ``most_keys`` terms (or are one shard), so what
    is broadcast is bounded; the running sum is over a row per shard.
    """
    before = F.sum(F.size("terms")).over(Window.orderBy("lang", "shard")) - 1
    dealt = materialise(
        shards.withColumn("round", F.floor(before / F.lit(most_keys)).cast("int")), "audit-rounds"
    )
    rounds = sorted(r[0] for r in dealt.select("round").distinct().collect())
    schema = "lang string, source string, shard int, slot int, n long"
    counted = docs.sparkSession.createDataFrame([], schema)
    for number in rounds:
        rows = dealt.where(F.col("round") == number).drop("round").orderBy("lang", "shard").toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as out:
            out.write_table(rows)
        sent = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())
        counted = counted.unionByName(docs.select("lang", "source", "text").mapInArrow(counter_of(sent), schema))
    summed = counted.groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))
    return materialise(summed, "audit-counts")


def counter_of(sent):
    """A task's second pass: dense slots per group are incremented, and handed on when they fill up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = TermTable(pa.ipc.open_stream(sent.value).read_all())
        dense: dict[tuple[str, str], np.ndarray] = {}

        def told():
            for (lang, source), counts in dense.items():
                first, _ = table.run(lang)
                slots = np.flatnonzero(counts)
                row = np.searchsorted(table.start, slots + first, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(slots), pa.string()),
                        pa.array([source] * len(slots), pa.string()),
                        pa.array(table.shard[row], pa.int32()),
                        pa.array(slots + first - table.start[row], pa.int32()),
                        pa.array(counts[slots]),
                    ],
                    names=["lang", "source", "shard", "slot", "n"],
                )
            dense.clear()

        def add(group: tuple[str, str], counts: Counter) -> None:
            first, end = table.run(group[0])
            if group not in dense:
                dense[group] = np.zeros(end - first, np.int64)
            slots = table.slots(group[0], list(counts))
            known = slots >= 0
            dense[group][slots[known] - first] += np.fromiter(counts.values(), np.int64, len(counts))[known]

        for batch in batches:
            held: dict[tuple[str, str], Counter] = {}
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group, text in zip(keys, batch.column("text"), strict=True):
                if group[0] not in table.rows:
                    continue
                counts = held.setdefault(group, Counter())
                for piece in terms(text.as_py()):
                    counts.update(piece)
                    if len(counts) > HELD_TERMS:
                        add(group, counts)
                        counts.clear()
            for group, counts in held.items():
                add(group, counts)
                if sum(map(len, dense.values())) > CELLS:
                    yield from told()
        yield from told()

    return run


def share(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10**9 (count + 5) / (total + 5 kept)) in whole numbers of 64 bits: long division by steps of 1000."""
    whole = total + SMOOTHING * kept
    rest, found = counts + SMOOTHING, np.zeros(np.broadcast(counts, whole).shape, np.int64)
    for step in SCALE_STEPS:
        rest = rest * step
        found = found * step + rest // whole
        rest = rest % whole
    return found + 1


FOUND = "lang string, part string, source string, item string, value long"


def compare_shard(rows: pa.Table, shard: pa.Table) -> pa.Table:
    """What one shard of a language adds to its pairs, and the best terms it offers to each source.

    ``rows``: a marker per source (slot null; n its total, kept the language's
    terms) and the counts of the shard's slots.
    """
    marked = rows.filter(pc.is_null(rows["slot"])).sort_by("source")
    sources, totals = marked["source"].to_pylist(), marked["n"].to_numpy()
    lang, kept = rows["lang"][0].as_py(), marked["kept"][0].as_py()
    words = shard["terms"][0].as_py() if shard.num_rows else []
    counted = rows.filter(pc.is_valid(rows["slot"]))
    counts = np.zeros((len(sources), len(words)), np.int64)
    at = pc.index_in(counted["source"], value_set=marked["source"].combine_chunks()).to_numpy()
    counts[at, counted["slot"].to_numpy()] = counted["n"].to_numpy()
    part, left, right, value = [], [], [], []
    shares = share(counts, totals[:, None], kept) if words else counts
    for i in range(len(sources) - 1):
        apart = np.abs(shares[i + 1 :] - shares[i]).sum(1)
        part += ["pair"] * len(apart)
        left += [sources[i]] * len(apart)
        right += sources[i + 1 :]
        value += apart.tolist()
    if words:
        over = shares - share(counts.sum(0), totals.sum(), kept)
        names = np.argsort(np.argsort(np.array(words, dtype=object)))
        for i, source in enumerate(sources):
            good = np.flatnonzero((counts[i] > 0) & (over[i] > 0))
            good = good[np.lexsort((names[good], -over[i][good]))][:TOP_TERMS]
            part += ["term"] * len(good)
            left += [source] * len(good)
            right += [words[j].decode() for j in good]
            value += over[i][good].tolist()
    schema = pa.schema([*((c, pa.string()) for c in ("lang", "part", "source", "item")), ("value", pa.int64())])
    return pa.table([[lang] * len(part), part, left, right, value], schema=schema)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, most_keys: int = MOST_KEYS) -> DataFrame:
    """(lang, source, part, item, value, rank): how the sources of a language differ, and in which terms.

    A null text, lang or source counts as ''. The first pass counts exactly in how
    many documents of a language each term occurs; terms of ``least_docs`` or more
    are kept and get a slot each by minimal perfect hashes, one per shard, which
    store their keys. The second pass increments a slot per occurrence and group.
    Part ``pair``: the sum over kept terms of the absolute difference to every
    other source of the language, 0 where nothing is kept. Part ``term``: the 50
    terms by which a source exceeds its language most. A repeated row counts again,
    other columns are ignored, a language with one source has no pairs, an empty
    table gives no rows.
    """

    def given(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    docs = docs.select(given("lang"), given("source"), given("text").cast("binary").alias("text"))
    groups = materialise(docs.select("lang", "source").distinct(), "audit-groups")
    most_sources = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    shards = kept_shards(docs, least_docs, most_sources)
    counts = slot_counts(docs, shards, most_keys)
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kept = shards.groupBy("lang").agg(
        F.sum(F.size("terms")).alias("kept"), F.max("shards").alias("shards")
    )
    markers = (
        groups.join(totals, ["lang", "source"], "left")
        .join(few_or_shuffled(materialise(kept, "audit-kept")), "lang", "left")
        .select(
            "lang",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("shards"), F.lit(1)) - 1)).alias("shard"),
            "source",
            F.lit(None).cast("int").alias("slot"),
            F.coalesce("n", F.lit(0).cast("long")).alias("n"),
            F.coalesce("kept", F.lit(0).cast("long")).alias("kept"),
        )
    )
    rows = markers.unionByName(counts.withColumn("kept", F.lit(None).cast("long")))
    by = ["lang", "shard"]
    found = materialise(
        rows.groupBy(*by).cogroup(shards.select(*by, "terms").groupBy(*by)).applyInArrow(compare_shard, FOUND),
        "audit-parts",
    )
    pairs = (
        found.where("part = 'pair'")
        .groupBy("lang", "part", "source", "item")
        .agg(F.sum("value").alias("value"))
        .withColumn("both", F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))))
        .select("lang", "part", "both.source", "both.item", "value")
    )
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    top = found.where("part = 'term'").withColumn("rank", F.row_number().over(best))
    ranked = pairs.withColumn("rank", F.row_number().over(best)).unionByName(top.where(F.col("rank") <= TOP_TERMS))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
