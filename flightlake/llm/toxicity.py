"""Toxic passages as maximal-scoring segments of token log-odds, judged by extreme-value statistics."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.training import labelled, logistic, sigmoid
from flightlake.session import materialise

TOKEN = re.compile(r"[^\W\d_]+")
PREFIX = 5
PRIOR_SHARE = 0.05
#: What is taken off every token's log-odds, the first that calibrates best to within a hundredth.
DRIFTS = (2.0, 1.0, 0.5, 0.0)
MOST_TRAINING_DOCS = 20_000


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


@dataclass
class Model:
    """Scores of the tokens that speak for or against toxicity; any other token scores ``-drift``."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    plain: set[str] = field(default_factory=set)
    drift: float = DRIFTS[0]
    decay: float = 1.0
    rate: float = 1.0
    slope: float = 0.0
    intercept: float = -35.0

    def hits(self, found: list[str]) -> list[tuple[int, float]]:
        """(place, score) of the tokens with a score of their own; a word never learned goes by its start."""
        words, prefixes, plain = self.words, self.prefixes, self.plain
        out = []
        for i, w in enumerate(found):
            if w in words:
                out.append((i, words[w]))
            elif w[:PREFIX] in prefixes and w not in plain:
                out.append((i, prefixes[w[:PREFIX]]))
        return out

    def expected(self, score: float, n: int) -> float:
        """Passages of such a score expected in n harmless tokens."""
        return self.rate * max(1, n) * float(np.exp(-self.decay * score))

    def surprise(self, scores: list[float], n: int) -> float:
        """-log of the chance that the passages of n harmless tokens score as high; 0 without passages.

        The best r passages are judged together by the tail of their normalised
        sum, for the r at which they are the least likely.
        """
        total, most, factorials = 0.0, 0.0, 0.0
        for r, score in enumerate(sorted(scores, reverse=True), 1):
            total += self.decay * score - math.log(self.rate * max(1, n))
            factorials += math.log(r) + (math.log(r - 1) if r > 1 else 0.0)
            tail = total - (r - 1) * math.log(max(total, 1.0)) + factorials
            if tail <= 30:
                tail = -math.log(-math.expm1(-math.exp(-tail)))
            most = max(most, tail)
        return most

    def probability(self, surprise: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * np.log1p(surprise) + self.intercept)


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (first, last token, score), in one pass over the hits.

    Tokens between hits cost ``drift`` each. Each hit above zero opens a segment; as
    long as an earlier one has a lower sum before it and a lower sum after it, the
    two merge. Every hit is pushed once and merged once, and each segment knows the
    nearest one before it with a lower sum, so none is passed over twice.
    """
    stack: list[tuple[float, float, int, int, int]] = []
    total, at = 0.0, 0
    for i, score in hits:
        total -= drift * (i - at)
        left, right, first = total, total + score, i
        total, at = right, i + 1
        if score <= 0:
            continue
        lower = len(stack) - 1
        while True:
            while lower >= 0 and stack[lower][0] >= left:
                lower = stack[lower][4]
            if lower < 0 or stack[lower][1] >= right:
                break
            merged = lower
            left, _, first, _, lower = stack[merged]
            del stack[merged:]
        stack.append((left, right, first, i, lower))
    return [(first, last, right - left) for left, right, first, last, _ in stack]


def log_odds(y1: np.ndarray, y0: np.ndarray, n1: float, n0: float) -> tuple[np.ndarray, np.ndarray]:
    """(log-odds ratio, its standard error) under a Dirichlet prior.

    The prior is shaped like the whole corpus and has PRIOR_SHARE of its size.
    """
    prior, size = PRIOR_SHARE * (y1 + y0), PRIOR_SHARE * (n1 + n0)
    a, b = y1 + prior, y0 + prior
    ratio = np.log(a / (n1 + size - a)) - np.log(b / (n0 + size - b))
    return ratio, np.sqrt(1 / a + 1 / b)


def shrunk(ratio: np.ndarray, error: np.ndarray) -> np.ndarray:
    """Log-odds a standard error nearer to 0, which is what a token never seen has."""
    return np.sign(ratio) * np.maximum(np.abs(ratio) - error, 0)


def token_counts(rows: DataFrame) -> DataFrame:
    """(token, y1, y0) of words and, as ``start*``, of word starts; summed per batch before the shuffle.

    A line counts once for either label, so words of a passage that many texts
    copy don't look like words that many texts use.
    """
    lines = rows.select(F.explode(F.split("text", "\n")).alias("text"), "label").distinct()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(), Counter()
            pairs = zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True)
            for text, label in pairs:
                found = Counter(tokens(text or ""))
                seen[label].update(found)
                for word, n in found.items():
                    if len(word) > PREFIX:
                        seen[label][word[:PREFIX] + "*"] += n
            words = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string())]
                + [pa.array([seen[k][w] for w in words], pa.int64()) for k in (1, 0)],
                names=["token", "y1", "y0"],
            )

    counted = lines.mapInArrow(count, "token string, y1 long, y0 long")
    return counted.groupBy("token").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0"))


def segment_scores(rows: DataFrame, model: Model) -> DataFrame:
    """(scores, n, label) per labelled row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, length = [], []
            for text in batch.column("text").to_pylist():
                found = tokens(text or "")
                scores.append([float(s[2]) for s in segments(model.hits(found), model.drift)])
                length.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(scores, pa.list_(pa.float64())), pa.array(length, pa.int64()), batch.column("label")],
                names=["scores", "n", "label"],
            )

    return rows.mapInArrow(run, "scores array<double>, n long, label int")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    most_docs: int = MOST_TRAINING_DOCS,
) -> Model:
    """Log-odds from three folds, calibration from the fourth, the fifth held out.

    Every token whose log-odds are more than their error keeps them, less the
    drift: clear words, mild ones and those that speak against toxicity. The drift
    is the one of ``DRIFTS`` that calibrates best: a large one finds passages in
    otherwise harmless texts, none at all judges texts by all their words. The
    tables that reach the driver (the sample's tokens that occur twice, the segment
    scores of its calibration texts) are bounded by the sample (:func:`labelled`).
    Without toxic examples nothing scores.
    """
    rows = materialise(labelled(docs, labels, label, id_col, text_col, most_docs), "toxic-sample")
    counted = materialise(token_counts(rows.where("fold <> 1")), "toxic-tokens")
    word = ~F.col("token").endswith("*")
    n1, n0 = (float(x or 0) for x in counted.where(word).agg(F.sum("y1"), F.sum("y0")).first())
    if not n1 or not n0:
        return Model()
    frequent = counted.where("y1 + y0 >= 2").toPandas()
    y1, y0 = frequent["y1"].to_numpy(float), frequent["y0"].to_numpy(float)
    odds = shrunk(*log_odds(y1, y0, n1, n0))
    size = PRIOR_SHARE * (n1 + n0)
    shares = (y0 + PRIOR_SHARE * (y1 + y0)) / (n0 + size)
    told = np.array([t[-1] != "*" for t in frequent["token"]], bool) & (odds != 0)
    toxic_start = np.array([t[-1] == "*" for t in frequent["token"]], bool) & (y1 >= 2)
    held = rows.where("fold = 1")
    best, least = Model(), math.inf
    for drift in DRIFTS:
        model = Model(drift=drift)
        starts = toxic_start & (odds > max(drift, 0.5))
        model.words = dict(zip(frequent["token"][told], odds[told] - drift, strict=True))
        model.prefixes = {t[:-1]: s - drift for t, s in zip(frequent["token"][starts], odds[starts], strict=True)}
        if model.prefixes:
            known = counted.where(word & F.substring("token", 1, PREFIX).isin(list(model.prefixes)) & (F.col("y0") > 0))
            model.plain = {r["token"] for r in known.select("token").collect()}
        model.decay = decay(shares[told], odds[told] - drift, drift)
        loss = calibrate(model, held)
        if loss < 0.99 * least:
            best, least = model, loss
    return best


def calibrate(model: Model, held: DataFrame) -> float:
    """Sets rate, slope and intercept by labelled texts; returns the mean log loss on them."""
    rows = segment_scores(held, model).collect()
    n, y = (np.array([r[c] for r in rows], float) for c in ("n", "label"))
    best = np.array([max(r["scores"], default=0.0) for r in rows], float)
    clean = y == 0
    model.rate = max(clean.sum(), 1) / max(1.0, (n[clean] * np.exp(-model.decay * best[clean])).sum())
    surprise = np.array([model.surprise(r["scores"], r["n"]) for r in rows], float)
    model.slope, model.intercept = logistic(np.log1p(surprise), y)
    p = np.clip(model.probability(surprise), 1e-9, 1 - 1e-9)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()) if len(y) else 0.0


def decay(shares: np.ndarray, scores: np.ndarray, drift: float) -> float:
    """The exponent at which harmless tokens' scores average to 1: the decay of the best score's tail."""
    rest = 1 - shares.sum()
    low, high = 0.0, 5.0
    for _ in range(60):
        middle = (low + high) / 2
        if (shares * np.exp(middle * scores)).sum() + rest * np.exp(-middle * drift) < 1:
            low = middle
        else:
            high = middle
    return max(low, 0.05)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", significance: float = 0.05
) -> DataFrame:
    """(id_col, score, passages) per row: P(toxic) and every significant passage.

    Whole texts are scanned once, however long. A passage (start, end, score,
    expected) is a maximal-scoring segment of which fewer than ``significance``
    are expected in as many harmless tokens; places count code points of the
    text. Null and empty texts have no tokens and get the score of such a text;
    repeated rows and null ids are scored like any other.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    passage = pa.struct(
        [("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]
    )

    def passages(text: str, found: list[tuple[int, int, float]], n: int) -> list[dict]:
        kept = [(a, b, s, model.expected(s, n)) for a, b, s in found]
        kept = [x for x in kept if x[3] < significance]
        if not kept:
            return []
        spans = lower_spans(text)
        return [
            {"start": spans[a][0], "end": spans[b][1], "score": s, "expected": e} for a, b, s, e in kept
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            surprise, held = [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                words = tokens(text)
                found = segments(model.hits(words), model.drift)
                surprise.append(model.surprise([s[2] for s in found], len(words)))
                held.append(passages(text, found, len(words)) if found else [])
            p = model.probability(np.array(surprise, float))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(p, pa.float64()), pa.array(held, pa.list_(passage))],
                names=["id", "score", "passages"],
            )

    schema = (
        f"id {kind}, score double, "
        "passages array<struct<start:bigint,end:bigint,score:double,expected:double>>"
    )
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def lower_spans(text: str) -> list[tuple[int, int]]:
    """Places of the tokens in the text itself, also where a letter gets longer in lower case."""
    lower = text.lower()
    if len(lower) == len(text):
        return [m.span() for m in TOKEN.finditer(lower)]
    place = [i for i, c in enumerate(text) for _ in c.lower()]
    return [(place[a], place[b - 1] + 1) for a, b in (m.span() for m in TOKEN.finditer(lower))]
