"""Labelled rows for the classifiers, and a two-parameter calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import materialise

FOLDS = 5
MOST_TRAINING_LINES = 2_000_000


def fold(id_col: str) -> Column:
    """0 to 4 by the CRC-32 of the id as text; fold 0 is held out."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def held_out(id_col: str) -> Column:
    """A null id is in no fold and never has a label."""
    return F.coalesce(fold(id_col) == 0, F.lit(False))


def labelled(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    id_col: str,
    text_col: str,
    most_docs: int,
    most_lines: int = MOST_TRAINING_LINES,
) -> DataFrame:
    """(text, label, fold), written: at most ``most_docs`` labelled ids outside fold 0, drawn by a hash of the id.

    Null labels and ids are left out; an id labelled twice has its larger label,
    and of rows that repeat an id one text counts, the one with the least hash.
    Together the texts have at most ``most_lines`` lines, a hundred characters
    counting as a line more, and one text a twentieth of that; of what exceeds it
    nothing is learned. The drawn ids are sent to the tasks, bounded by
    ``most_docs``, so of all texts only theirs move.
    """
    usable = (
        labels.select(F.col(id_col).alias("_label_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isNotNull() & (fold("_label_id") != 0))
        .groupBy("_label_id")
        .agg(F.max("label").alias("label"))
    )
    drawn = usable.orderBy(F.xxhash64("_label_id")).limit(most_docs)
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = F.regexp_count("text", F.lit("\n")) + 1 + F.expr("length(text) div 100")
    sized = rows.join(F.broadcast(drawn), F.col("_id") == F.col("_label_id")).withColumn("lines", lines)
    single = (
        sized.where(F.col("lines") <= most_lines // 20)
        .groupBy("_id", "label")
        .agg(F.min_by(F.struct("text", "lines"), F.xxhash64("text")).alias("one"))
        .select("_id", "label", "one.*")
    )
    single = materialise(single, f"{label}-labelled")
    by_hash = Window.orderBy(F.xxhash64("_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = single.select("_id", F.sum("lines").over(by_hash).alias("upto")).where(F.col("upto") <= most_lines)
    return single.join(F.broadcast(fitting), "_id").select("text", "label", fold("_id").alias("fold"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, float]:
    """(slope, intercept) of P(y = 1), slightly shrunk, by Newton steps; a constant if one class is missing."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return 0.0, float(np.log(share / (1 - share)))
    shift, scale = x.mean(), max(1e-9, x.std())
    design = np.column_stack([(x - shift) / scale, np.ones(len(x))])
    penalty = np.diag([ridge, 1e-6])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ w
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1] - w[0] * shift / scale)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
