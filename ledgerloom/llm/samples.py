"""Bounded samples of labelled rows, and small fits on what Spark has summed over them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import written

#: Most labelled rows a classifier is fitted on.
MOST_ROWS = 20_000


def labelled(docs: DataFrame, labels: DataFrame, train: Column, *, id_col: str = "doc_id", text: str = "text", label: str, most_rows: int = MOST_ROWS) -> DataFrame:
    """``text, label, fold`` of at most ``most_rows`` labelled ids for which ``train`` holds, chosen by a hash of the id.

    ``labels`` has the id and the label; ids without a text or a label are left out. An id with several texts gives each; with
    several labels, the largest. ``fold`` (0 to 3) parts the sample for calibration. The chosen ids, whose number is bounded,
    are broadcast to the documents, so texts are not shuffled; the sample is written to the shared folder.
    """
    chosen = (
        labels.where(train & F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("chosen_id"))
        .agg(F.max(label).alias("chosen_label")).orderBy(F.xxhash64(F.col("chosen_id").cast("string")), "chosen_id").limit(most_rows)
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("sample_id"), F.col(f"`{text}`").cast("string").alias("sample_text")).where("sample_text is not null")
    return written(
        rows.join(F.broadcast(chosen), F.col("sample_id") == F.col("chosen_id"))
        .select(F.col("sample_text").alias("text"), F.col("chosen_label").alias("label"), F.pmod(F.xxhash64(F.lit("fold"), F.col("sample_id").cast("string")), F.lit(4)).cast("int").alias("fold")),
        "sample",
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Weights of a logistic regression, the last for the constant, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing step function nearest to ``y`` over ``score`` (pool adjacent violators)."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []
    for s, v in zip(score[order], y[order], strict=True):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
            b = blocks.pop()
            a = blocks[-1]
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1] += b[1]
            a[3] = b[3]
    at = np.array([p for b in blocks for p in (b[2], b[3])])
    value = np.array([v for b in blocks for v in (b[0], b[0])])
    return at, value
