"""Quality classifier: random Fourier features of document statistics, ridge by summed normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.samples import MOST_ROWS, fit_isotonic, labelled
from ledgerloom.llm.shared import whole_row, written

STATISTICS = (
    "log_chars", "log_words", "word_length", "upper", "digits", "marks", "exclamations", "bars", "stops", "commas", "other_punctuation", "beyond_ascii",
    "line_words", "short_lines", "repeated_lines", "distinct_words", "stutter", "top_word", "shouted_words", "marked_words", "spread",
)


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; shares are per character, word or line."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    bytes_of = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) if raw else np.zeros(256, dtype=np.int64)
    count = lambda s: int(bytes_of[list(s)].sum())
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, chars, n_lines = max(1, len(words)), max(1, len(raw) - int(bytes_of[0x80:0xC0].sum())), max(1, len(lines))
    tally: dict[bytes, int] = {}
    for w in words:
        tally[w] = tally.get(w, 0) + 1
    share = bytes_of[bytes_of > 0] / max(1, len(raw))
    return [
        np.log1p(chars), np.log1p(len(words)), sum(map(len, words)) / n, count(range(65, 91)) / chars, count(range(48, 58)) / chars,
        count(b"#*$%&|<>@^~_=+\\") / chars, count(b"!") / n, count(b"|") / n, count(b".?") / n, count(b",;:") / n, count(b"\"'()[]{}/-") / n,
        int(bytes_of[0xC0:].sum()) / chars, np.log1p(len(words) / n_lines), sum(len(x) < 20 for x in lines) / n_lines, 1 - len(set(lines)) / n_lines,
        len(tally) / n, sum(map(bytes.__eq__, words[1:], words)) / n, max(tally.values(), default=0) / n, sum(map(bytes.isupper, words)) / n,
        sum(1 for w in words if w[-1] in b"#*$%&!|<>") / n, float(-(share * np.log(share)).sum()),
    ]


@dataclass
class QualityModel:
    """Standardisation, the random features' frequencies and phases, ridge weights, and the calibration's knots."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.sqrt(2 / len(self.phases)) * np.cos(z @ self.frequencies + self.phases), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.value), 0, 1)


def with_statistics(docs: DataFrame, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` and ``x``, the statistics of each whole text."""
    row = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    schema = T.StructType([T.StructField("row", row.schema), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([statistics(v.as_py()) for v in batch.column("body")], pa.list_(pa.float64()))], names=["row", "x"])

    return docs.select(whole_row(row), F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1) if len(column) else np.zeros((0, len(STATISTICS)))


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, *, id_col: str = "doc_id", text: str = "text", label: str = "quality",
    most_rows: int = MOST_ROWS, width: int = 256, gamma: float = 0.03, ridge: float = 1.0, seed: int = 17,
) -> QualityModel:
    """A model from at most ``most_rows`` labelled documents.

    The features' random numbers come from ``seed``. Each task sums the normal equations of its rows; Spark adds them up per
    matrix row, and the driver solves the ``width + 1`` equations. Isotonic calibration uses the fourth fold, whose
    scores are bounded by ``most_rows``. With labels of one kind only, or none, every score is that kind's share (or 0.5).
    """
    sample = written(with_statistics(labelled(docs, labels, train, id_col=id_col, text=text, label=label, most_rows=most_rows), keep=["label", "fold"]), "statistics")
    columns = [F.col("x")[i] for i in range(len(STATISTICS))]
    moments = sample.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]).first()
    values = np.array([np.nan if v is None else v for v in moments], dtype=float)
    mean, scale = np.nan_to_num(values[: len(columns)]), np.nan_to_num(values[len(columns) :])
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean, np.where(scale > 1e-9, scale, 1.0), rng.normal(0, np.sqrt(2 * gamma), (len(columns), width)), rng.uniform(0, 2 * np.pi, width),
        np.zeros(width + 1), np.array([0.0]), np.array([0.5]),
    )
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 2))
        for batch in batches:
            z = shipped.value.features(_matrix(batch.column("x")))
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())], names=["k", "sums"])

    def added(table: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(v.as_py()) for v in table.column("sums")], axis=0)
        return pa.table({"k": table.column("k")[:1].cast(pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})

    learning = sample.where("row.fold <> 3").select("x", "row.label")
    rows = learning.mapInArrow(equations, "k int, sums binary").groupBy("k").applyInArrow(added, "k int, sums binary").collect()
    system = np.zeros((width + 1, width + 2))
    for r in rows:
        system[r["k"]] = np.frombuffer(r["sums"])
    damping = ridge * np.eye(width + 1)
    damping[-1, -1] = 1e-6
    model.weights = np.linalg.solve(system[:, :-1] + damping, system[:, -1])
    known = sample.select("x", "row.label", "row.fold").toPandas()
    if len(known):
        part = known[known["fold"] == 3] if known[known["fold"] == 3]["label"].nunique() == 2 else known
        model.at, model.value = fit_isotonic(model.raw(np.stack(part["x"].to_numpy())), part["label"].to_numpy(float))
    return model


def score_quality(docs: DataFrame, model: QualityModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default) and ``score`` from 0 to 1 of each whole text.

    Null and empty texts have the statistics of no words; repeated rows get equal scores; columns of any name stay in ``row``.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    row = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    schema = T.StructType([T.StructField("row", row.schema), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(v.as_py()) for v in batch.column("body")]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(shipped.value.score(x))], names=["row", "score"])

    return docs.select(whole_row(row), F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, schema)
