"""Document quality from a linear-chain conditional random field that labels every line good or bad."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.training import labelled, logistic, sigmoid
from flightlake.session import materialise

MOST_TRAINING_DOCS = 6_000
ROUNDS = 3
STEPS = 150
SYMBOLS = re.compile(r"[#*$%&|<>{}\[\]=_/\\~^@+]")
LETTERS = re.compile(r"[^\W\d_]")
FEATURES = 18


def line_features(line: str, seen: bool) -> list[float]:
    """Fixed measures of one line; ``seen``: an earlier line of the text is equal."""
    words = line.split()
    n, chars = len(words), len(line)
    if not n:
        return [0.0] * (FEATURES - 1) + [1.0]
    letters = len(LETTERS.findall(line))
    windows = max(1, n - 2)
    return [
        np.log1p(n) / 5,
        np.log1p(chars) / 7,
        chars / n / 10 if chars < 40 * n else 4.0,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(words)) / n,
        1 - len(set(zip(words, words[1:], words[2:]))) / windows if n > 2 else 0.0,
        min(3.0, line.count("!") / n),
        min(3.0, line.count("|") / n),
        min(3.0, len(SYMBOLS.findall(line)) / n),
        sum(w.isupper() for w in words) / n,
        sum(c.isdigit() for c in line) / chars,
        letters / chars,
        sum(len(w) <= 3 for w in words) / n,
        float(line[0].islower()),
        float(line.rstrip()[-1] in ".!?:;\"'"),
        sum(w[-1] in ".,;:" for w in words) / n,
        float(seen),
        0.0,
    ]


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x measures, weights): own, previous and next line's measures, and each line's length."""
    lines, seen = text.split("\n"), set()
    own = np.zeros((len(lines), FEATURES))
    for i, line in enumerate(lines):
        own[i] = line_features(line, line in seen)
        seen.add(line)
    return with_neighbours(own), np.array([len(x) for x in lines], float)


def with_neighbours(own: np.ndarray) -> np.ndarray:
    around = np.zeros((len(own) + 2, FEATURES))
    around[1:-1] = own
    return np.hstack([around[1:-1], around[:-2], around[2:], np.ones((len(own), 1))])


@dataclass
class Model:
    """Weights of a line being bad, log-potentials of neighbouring labels, and the calibration."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float = 0.0
    intercept: float = 0.0


def padded(values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(documents x lines, mask): sequences of any length side by side."""
    lengths = np.array([len(v) for v in values])
    mask = np.arange(lengths.max()) < lengths[:, None]
    out = np.zeros((len(values), lengths.max(), *values[0].shape[1:]))
    out[mask] = np.concatenate(values)
    return out, mask


def forward_backward(bad: np.ndarray, mask: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals of bad, expected moves, log-partition) of all sequences at once.

    bad: scores of the bad label, the good one scoring 0; moves[i, j]: from label i to j.
    """
    n, length = bad.shape
    unary = np.stack([np.zeros_like(bad), bad], axis=2)
    ahead, behind = np.zeros((n, length, 2)), np.zeros((n, length, 2))
    ahead[:, 0] = unary[:, 0]
    for t in range(1, length):
        step = ahead[:, t - 1, :, None] + moves
        new = np.logaddexp(step[:, 0], step[:, 1]) + unary[:, t]
        ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = moves + (unary[:, t + 1] + behind[:, t + 1])[:, None, :]
        new = np.logaddexp(step[:, :, 0], step[:, :, 1])
        behind[:, t] = np.where(mask[:, t + 1, None], new, 0)
    whole = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    marginal = np.where(mask, np.exp(np.minimum(0, ahead[:, :, 1] + behind[:, :, 1] - whole[:, None])), 0)
    expected = np.zeros((2, 2))
    if length > 1:
        pair = ahead[:, :-1, :, None] + moves + (unary[:, 1:] + behind[:, 1:])[:, :, None, :]
        pair = np.exp(np.minimum(0, pair - whole[:, None, None, None]))
        expected = (pair * mask[:, 1:, None, None]).sum((0, 1))
    return marginal, expected, whole


def batches_of(features: list[np.ndarray], cells: int = 200_000) -> Iterator[list[int]]:
    """Documents by length, as many at a time as fill ``cells`` when padded."""
    order = sorted(range(len(features)), key=lambda i: len(features[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(features[order[end]]) <= cells:
            end += 1
        yield order[at:end]
        at = end


def marginals(model: Model, features: list[np.ndarray]) -> list[np.ndarray]:
    """P(bad) of every line."""
    out: list = [None] * len(features)
    for rows in batches_of(features):
        scores, mask = padded([features[i] @ model.weights for i in rows])
        found, _, _ = forward_backward(scores, mask, model.moves)
        for i, p in zip(rows, found, strict=True):
            out[i] = p[: len(features[i])]
    return out


def train(features: list[np.ndarray], lines: list[np.ndarray], model: Model, ridge: float = 1e-3) -> Model:
    """Maximum likelihood of the lines' labels by Adam steps over all documents."""
    w, moves = model.weights.copy(), model.moves.copy()
    total = sum(map(len, features))
    flat = np.concatenate(features)
    gold = np.concatenate(lines)
    gold_moves = np.zeros((2, 2))
    for y in lines:
        np.add.at(gold_moves, (y[:-1].astype(int), y[1:].astype(int)), 1)
    starts = np.cumsum([0, *map(len, features)])
    first, second = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, STEPS + 1):
        scores = flat @ w
        p, expected = np.zeros(len(flat)), np.zeros((2, 2))
        for rows in batches_of(features):
            batch, mask = padded([scores[starts[i] : starts[i + 1]] for i in rows])
            found, pairs, _ = forward_backward(batch, mask, moves)
            expected += pairs
            for i, m in zip(rows, found, strict=True):
                p[starts[i] : starts[i + 1]] = m[: len(features[i])]
        gradient = np.append(flat.T @ (p - gold), (expected - gold_moves).ravel()) / total
        gradient += ridge * np.append(w, moves.ravel())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        change = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, moves = w - change[:-4], moves - change[-4:].reshape(2, 2)
    return Model(w, moves)


def badness(p: np.ndarray, weights: np.ndarray) -> float:
    """Length-weighted share of bad lines; a text without characters counts by its lines."""
    total = weights.sum()
    return float((p * weights).sum() / total) if total else float(p.mean())


def logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 1e-4, 1 - 1e-4)
    return np.log(share / (1 - share))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
    most_docs: int = MOST_TRAINING_DOCS,
) -> Model:
    """The field learned from labelled documents outside the held-out fold, at most ``most_docs``.

    Only their lines' measures (bounded by the same number) reach the driver. Lines
    start with their document's label; in further rounds a bad document's lines
    that look good become good, but for the worst one. Three folds train, the
    fourth calibrates. Without labels of both kinds the score is a constant.
    """
    rows = materialise(labelled(docs, labels, label, id_col, text_col, most_docs), "quality-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [document_features(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([f[:, :FEATURES].astype(np.float32).tobytes() for f, _ in found], pa.binary()),
                    pa.array([w.tobytes() for _, w in found], pa.binary()),
                    batch.column("label"),
                    pa.array(batch.column("fold").to_pylist(), pa.int64()),
                ],
                names=["own", "weights", "label", "fold"],
            )

    measured = rows.mapInArrow(run, "own binary, weights binary, label int, fold long").toPandas()
    model = Model(np.zeros(3 * FEATURES + 1), np.zeros((2, 2)))
    features = [with_neighbours(np.frombuffer(x, np.float32).reshape(-1, FEATURES)) for x in measured["own"]]
    weights = [np.frombuffer(x) for x in measured["weights"]]
    y, fold = measured["label"].to_numpy(), measured["fold"].to_numpy()
    use = np.flatnonzero(fold != 1)
    if len(use) and y[use].min() != y[use].max():
        chosen = [features[i] for i in use]
        lines = [np.full(len(features[i]), 1.0 - y[i]) for i in use]
        for _ in range(ROUNDS):
            model = train(chosen, lines, model)
            for j, (i, p) in enumerate(zip(use, marginals(model, chosen), strict=True)):
                if y[i] == 0:
                    lines[j] = ((p >= 0.5) | (p == p.max())).astype(float)
    held = np.flatnonzero(fold == 1)
    found = marginals(model, [features[i] for i in held]) if len(held) else []
    share = np.array([badness(p, weights[i]) for p, i in zip(found, held, strict=True)], float)
    model.slope, model.intercept = logistic(logit(share), y[held].astype(float))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, lines): P(quality = 1) per row, and every line's chance to be bad.

    Whole texts are split at line ends and labelled, whatever their length; a
    null or empty text is one empty line. Repeated rows and null ids are scored
    like any other, an empty table stays empty.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                scores, lines = text_scores(part.column("text").to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(scores, pa.float64()), pa.array(lines, pa.list_(pa.float64()))],
                    names=["id", "score", "lines"],
                )

    found = rows.mapInArrow(run, f"id {kind}, score double, lines array<double>")
    return found.withColumnRenamed("id", id_col)


def kept(docs: DataFrame, model: Model, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores at least ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                yield part.filter(pa.array(text_scores(part.column(text_col).to_pylist(), model)[0] >= least))

    return docs.mapInArrow(run, docs.schema)


def text_scores(texts: list[str | None], model: Model) -> tuple[np.ndarray, list[np.ndarray]]:
    """(P(quality = 1), P(bad) of every line) of each text."""
    found = [document_features(t or "") for t in texts]
    p = marginals(model, [f for f, _ in found])
    share = np.array([badness(x, w) for x, (_, w) in zip(p, found, strict=True)])
    return sigmoid(model.slope * logit(share) + model.intercept), p
