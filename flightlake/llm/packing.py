"""Packing token pieces into fixed windows by non-negative least squares over their lengths."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import fresh, numbered

WINDOW = 1024
#: The white space at which the vocabulary's pattern breaks, and the pattern's look-ahead.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LOOK_AHEAD = r"\s+(?!\S)|"
SPECIAL = {"<|endoftext|>": 50256}
#: White space in one run from which on it is encoded apart: the look-ahead's engine gives up at a million.
LONG_RUN = 100_000


class Encoder:
    """Ids of whole texts as little-endian 32-bit integers.

    The look-ahead of the splitting pattern only matters where white space meets
    white space or the end; other texts are split by the pattern without it,
    which needs no backtracking and takes half the time. A special token's name
    in a text stands for the token. A very long run of white space is one word,
    less its last character where a word follows, and needs no look-ahead either.
    """

    def __init__(self, vocabulary: str):
        import base64
        import re

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        self.full = tiktoken.Encoding("full", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL)
        self.plain = tiktoken.Encoding(
            "plain", pat_str=pattern.replace(LOOK_AHEAD, ""), mergeable_ranks=ranks, special_tokens={}
        )
        self.uneven = re.compile(f"[{WHITE}][{WHITE}]|[{WHITE}]\\Z")
        self.white = re.compile(f"[{WHITE}]+")

    def __call__(self, text: str) -> bytes:
        if len(text) < LONG_RUN:
            return self.encoded(text)
        out, at = [], 0
        for run in self.white.finditer(text):
            first, end = run.span()
            if end - first >= LONG_RUN:
                if end < len(text) and not text.startswith(tuple(SPECIAL), end):
                    end -= 1
                out += [self.encoded(text[at:first]), self.encoded(text[first:end], self.plain)]
                at = end
        return b"".join([*out, self.encoded(text[at:])])

    def encoded(self, text: str, encoding=None) -> bytes:
        if encoding is not None:
            ids = encoding.encode_ordinary(text)
        elif any(name in text for name in SPECIAL):
            ids = self.full.encode(text, allowed_special="all")
        elif self.uneven.search(text):
            ids = self.full.encode_ordinary(text)
        else:
            ids = self.plain.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


def token_pieces(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Each document's ids, closed by id 0, cut into pieces of ``window`` ids and a rest.

    Returns (id_col, start, length, doc_tokens, ids): ids are little-endian
    32-bit integers. A null text counts as empty and gives the closing id alone;
    repeated rows and null ids give pieces of their own. Texts are read whole,
    however long. Other columns of ``docs`` aren't looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, doc_tokens long, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, width = Encoder(vocabulary), 4 * window
        for batch in batches:
            keys = batch.column("id")
            out, held = [], 0
            for at in range(0, batch.num_rows, 256):
                for row, text in enumerate(batch.column("text").slice(at, 256).to_pylist(), at):
                    ids = encoder(text or "") + b"\0\0\0\0"
                    out += [(row, p // 4, len(ids) // 4, ids[p : p + width]) for p in range(0, len(ids), width)]
                    held += len(ids)
                if held > 8_000_000:
                    yield pieces(keys, out)
                    out, held = [], 0
            yield pieces(keys, out)

    def pieces(keys: pa.Array, out: list) -> pa.RecordBatch:
        rows, starts, totals, ids = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays(
            [
                keys.take(pa.array(rows, pa.int64())),
                pa.array(starts, pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(totals, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=["id", "start", "length", "doc_tokens", "ids"],
        )

    return rows.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def combinations(window: int) -> list[tuple[int, ...]]:
    """Two or three lengths that fill the window exactly; of three, the least is on a grid of 1/32."""
    pairs = [(window - a, a) for a in range(1, window // 2 + 1)]
    grid = range(max(1, window // 32), window // 3 + 1, max(1, window // 32))
    triples = [(window - a - b, b, a) for a in grid for b in range(a, (window - a) // 2 + 1)]
    return pairs + triples


def solve(usage: np.ndarray, histogram: np.ndarray, steps: int = 1500) -> np.ndarray:
    """Non-negative x that brings the usage closest to the histogram, by accelerated projected gradient.

    usage: one row per combination with the indices (length less one) of its
    lengths; the last index beyond them stands for no length.
    """
    size = len(histogram)
    target = np.append(histogram / max(1.0, histogram.sum()), 0.0)

    def apply(x):
        got = np.bincount(usage.ravel(), np.repeat(x, usage.shape[1]), size + 1)
        got[size] = 0
        return got

    def back(y):
        return y[usage].sum(1)

    probe = np.ones(len(usage))
    for _ in range(30):
        probe = back(apply(probe))
        scale = np.linalg.norm(probe)
        probe /= scale
    x = ahead = np.zeros(len(usage))
    momentum = 1.0
    for _ in range(steps):
        new = np.maximum(0, ahead - back(apply(ahead) - target) / (1.05 * scale))
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x * max(1.0, histogram.sum())


def plan(counts: dict[int, int], window: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often), using up every count exactly.

    Bounded by the window alone: the histogram has one bin per length.
    """
    left = np.zeros(window + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    chosen: list[tuple[tuple[int, ...], int]] = []
    if left[window]:
        chosen.append(((window,), int(left[window])))
        left[window] = 0
    shapes = [c for c in combinations(window) if all(left[x] for x in c)]
    if shapes:
        usage = np.array([[x - 1 for x in (*c, *[window + 1] * (3 - len(c)))] for c in shapes])
        x = solve(usage, left[1 : window + 1].astype(float))
        for round_down in (True, False):
            for i in np.argsort(-x, kind="stable"):
                often = min(left[v] // shapes[i].count(v) for v in shapes[i])
                often = int(min(often, x[i])) if round_down else int(often)
                if often:
                    chosen.append((shapes[i], often))
                    for v in shapes[i]:
                        left[v] -= often
    return chosen + best_fit(left, window)


def best_fit(left: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Longest first, each into the fullest open sequences that still have room, whole counts at a time."""
    open_: dict[int, list[list]] = {}
    for length in range(window, 0, -1):
        n = int(left[length])
        while n:
            room = min((s for s in open_ if s >= length), default=window)
            often, held = open_[room].pop() if room in open_ else (max(1, n // (window // length)), ())
            if room in open_ and not open_[room]:
                del open_[room]
            copies = min(room // length, n)
            used = min(often, n // copies)
            if used < often and held:
                open_.setdefault(room, []).append([often - used, held])
            n -= used * copies
            open_.setdefault(room - length * copies, []).append([used, held + (length,) * copies])
    return [(held, often) for groups in open_.values() for often, held in groups]


def pack(pieces: DataFrame, window: int = WINDOW, order: list[str] | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``: every piece lies in one sequence of at most ``window`` ids.

    pieces: any rows with a ``length`` from 1 to ``window``; all their columns
    are kept (ids too, where there are any), but for a ``sequence_id`` or
    ``offset`` of their own, which are replaced. The histogram of lengths, at
    most ``window`` numbers, is all that reaches the driver; there shallow
    combinations of lengths that fill the window are weighed by non-negative
    least squares, rounded down and the rest packed greedily. A piece finds its
    place from its rank among the pieces of its length. Sequence ids run from 0;
    an empty table stays empty.
    """
    pieces = pieces.drop("sequence_id", "offset")
    number, place = fresh(pieces, "_number"), fresh(pieces, "_place")
    ranked = numbered(pieces, ["length", *(order or [])], number)
    counts = {r["length"]: r["count"] for r in ranked.groupBy("length").count().collect()}
    first, seen = np.zeros(window + 2, np.int64), 0
    for length in sorted(counts):
        first[length], seen = seen, seen + counts[length]
    slots, used, base = [], np.zeros(window + 1, np.int64), 0
    for lengths, often in plan(counts, window):
        at = 0
        for length in lengths:
            slots.append((length, used[length], base, at))
            used[length] += often
            at += length
        base += often
    slots = np.array(sorted(slots), np.int64).reshape(-1, 4)
    keys = (slots[:, 0] << 48) + slots[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def places(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        lengths = length.to_numpy(np.int64)
        rank = number.to_numpy(np.int64) - first[lengths]
        slot = slots[np.searchsorted(keys, (lengths << 48) + rank, "right") - 1]
        return pd.DataFrame({"sequence_id": slot[:, 2] + rank - slot[:, 1], "offset": slot[:, 3]})

    return (
        ranked.withColumn(place, places("length", number))
        .withColumns({c: F.col(f"`{place}`.{c}") for c in ("sequence_id", "offset")})
        .drop(number, place)
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences' ids, joined in offset order: (sequence_id, tokens, ids); a window bounds each group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"),
        F.aggregate(parts, F.lit(b""), lambda held, p: F.concat(held, p["ids"])).alias("ids"),
    )
