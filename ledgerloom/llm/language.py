"""Language identification: sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

Fitted by follow-the-regularised-leader with elastic-net penalties in shards whose models Spark averages after each
round, then calibrated by a temperature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.samples import MOST_ROWS, labelled
from ledgerloom.llm.shared import whole_row

UNKNOWN = "und"
#: Characters of a text that are turned into n-grams at once; consecutive pieces share the characters of one n-gram.
_PIECE = 1 << 18


@lru_cache(maxsize=4)
def _letters() -> np.ndarray:
    """Lower-case code point of each letter, 32 for all else."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def code_points(text: str | None) -> np.ndarray:
    """Letters in lower case with single spaces in between and around; empty if there is no letter."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    points = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    points = np.concatenate([[32], points, [32]]).astype(np.uint32)
    keep = points != 32
    if not keep.any():
        return np.zeros(0, dtype=np.uint32)
    keep[1:] |= points[:-1] != 32
    keep[0] = True
    return points[keep]


def buckets(points: np.ndarray, orders: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hash buckets of the n-grams of 1 to ``orders`` characters, and how often each occurs."""
    total = np.zeros(1 << bits, dtype=np.int64)
    shift = np.uint32(32 - bits)
    for at in range(0, len(points), _PIECE):
        piece = points[at : at + _PIECE + orders - 1]
        own = min(_PIECE, len(points) - at)
        h = np.zeros(len(piece), dtype=np.uint32)
        for n in range(orders):
            h = (h[: len(piece) - n] * np.uint32(0x01000193)) ^ (piece[n:] * np.uint32(0x9E3779B1))
            mixed = (h[:own] ^ (h[:own] >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            total += np.bincount(mixed >> shift, minlength=1 << bits)
            if not len(h):
                break
    index = np.flatnonzero(total)
    return index, total[index]


@dataclass
class LanguageModel:
    """Weights by bucket and class; ``idf`` by bucket; the temperature divides the sums before the softmax."""

    classes: list[str]
    idf: np.ndarray
    weights: np.ndarray
    orders: int
    bits: int
    temperature: float = 1.0

    def vector(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        index, count = buckets(points, self.orders, self.bits)
        x = (1 + np.log(count)) * self.idf[index]
        return index, x / max(1e-12, float(np.sqrt(x @ x)))

    def sums(self, points: np.ndarray) -> np.ndarray:
        index, x = self.vector(points)
        return x @ self.weights[index]

    def probabilities(self, sums: np.ndarray) -> np.ndarray:
        z = sums / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Ftrl:
    """Per-coordinate follow-the-regularised-leader state for the weights of all classes."""

    z: np.ndarray
    n: np.ndarray
    alpha: float
    beta: float
    l1: float
    l2: float

    def weights(self, index: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[index], self.n[index]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def step(self, index: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(index)
        s = x @ w
        p = np.exp(s - s.max())
        p /= p.sum()
        p[y] -= 1
        g = x[:, None] * p[None, :]
        old = self.n[index]
        new = old + g * g
        self.z[index] += g - (np.sqrt(new) - np.sqrt(old)) / self.alpha * w
        self.n[index] = new


@lru_cache(maxsize=4)
def _model(shipped: Broadcast) -> LanguageModel:
    return shipped.value


def fit(
    docs: DataFrame, train: Column, *, id_col: str = "doc_id", text: str = "text", label: str = "lang", most_rows: int = MOST_ROWS, orders: int = 3, bits: int = 16,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.05, l2: float = 0.5, rounds: int = 2, shards: int = 4,
) -> LanguageModel:
    """A model from at most ``most_rows`` documents with a label.

    Document frequencies are summed per task and by Spark. In each round every shard runs over its rows from the averaged
    state of the round before; the states, ``2 ** bits`` rows of one number per class, are averaged per block of buckets.
    The temperature is fitted on the fourth fold. With no labelled document there is no class, and all is ``und``.
    """
    spark = docs.sparkSession
    sample = labelled(docs, docs.select(id_col, label), train, id_col=id_col, text=text, label=label, most_rows=most_rows).withColumn("label", F.col("label").cast("string"))
    classes = [r["label"] for r in sample.select("label").distinct().orderBy("label").collect()]
    size, k = 1 << bits, max(1, len(classes))
    blocks = 16
    learning = sample.where("fold <> 3").select("text", "label")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size), 0
        for batch in batches:
            for v in batch.column("text"):
                total[buckets(code_points(v.as_py()), orders, bits)[0]] += 1
                rows += 1
        yield _block_rows(total.reshape(blocks, -1), rows)

    def _block_rows(parts: np.ndarray, rows: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(range(blocks), pa.int32()), pa.array([rows] * blocks, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "n", "sums"])

    def added(table: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(v.as_py()) for v in table.column("sums")], axis=0)
        n = sum(table.column("n").to_pylist())
        return pa.table({"block": table.column("block")[:1].cast(pa.int32()), "n": pa.array([n], pa.int64()), "sums": pa.array([sums.tobytes()], pa.binary())})

    def total(df: DataFrame) -> tuple[int, np.ndarray]:
        rows = sorted(df.groupBy("block").applyInArrow(added, "block int, n long, sums binary").collect(), key=lambda r: r["block"])
        return (rows[0]["n"], np.concatenate([np.frombuffer(r["sums"]) for r in rows])) if rows else (0, np.zeros(size))

    n, seen = total(learning.mapInArrow(frequencies, "block int, n long, sums binary"))
    model = LanguageModel(classes, np.log((1 + n) / (1 + seen)) + 1, np.zeros((size, k)), orders, bits)
    if not classes:
        return model
    state = Ftrl(np.zeros((size, k)), np.zeros((size, k)), alpha, beta, l1, l2)
    dealt = learning.repartition(shards)
    for _ in range(rounds):
        shipped = spark.sparkContext.broadcast((model, state))

        def learn(batches: Iterator[pa.RecordBatch], shipped: Broadcast = shipped) -> Iterator[pa.RecordBatch]:
            at, start = shipped.value
            own = Ftrl(start.z.copy(), start.n.copy(), start.alpha, start.beta, start.l1, start.l2)
            place = {c: i for i, c in enumerate(at.classes)}
            rows = 0
            for batch in batches:
                for v, y in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                    points = code_points(v.as_py())
                    if len(points):
                        own.step(*at.vector(points), place[y])
                        rows += 1
            if rows:
                yield _block_rows(np.stack([own.z, own.n]).reshape(2, blocks, -1).transpose(1, 0, 2).reshape(blocks, -1) * rows, rows)

        rows, sums = total(dealt.mapInArrow(learn, "block int, n long, sums binary"))
        if rows:
            z, nn = (sums / rows).reshape(blocks, 2, -1).transpose(1, 0, 2).reshape(2, size, k)
            state = Ftrl(z, nn, alpha, beta, l1, l2)
    model.weights = state.weights(slice(None))
    model.temperature = _temperature(model, sample)
    return model


def _temperature(model: LanguageModel, sample: DataFrame) -> float:
    """The temperature of the least log loss on the fourth fold."""
    shipped = sample.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_model(shipped).sums(p) if len(p := code_points(v.as_py())) else None for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.list_(pa.float64()))], names=["label", "sums"])

    rows = sample.where("fold = 3").select("text", "label").mapInArrow(sums, "label string, sums array<double>").where("sums is not null").collect()
    if not rows:
        return 1.0
    s = np.array([r["sums"] for r in rows])
    y = np.array([model.classes.index(r["label"]) for r in rows])

    def loss(t: float) -> float:
        z = s / t
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(y)), y]))

    return float(min(np.exp(np.linspace(np.log(0.02), np.log(20), 241)), key=loss))


def identify(docs: DataFrame, model: LanguageModel, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), ``lang_pred`` and its probability ``score`` for each whole text.

    A text that is null or has no letter is ``und`` with score 0; on a tie the first class in order of name wins.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    row = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    schema = T.StructType([T.StructField("row", row.schema), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(shipped)
        for batch in batches:
            names, scores = [], []
            for v in batch.column("body"):
                points = code_points(v.as_py())
                if not len(points) or not m.classes:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                p = m.probabilities(m.sums(points))
                best = int(np.argmax(p))
                names.append(m.classes[best])
                scores.append(float(p[best]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["row", "lang_pred", "score"])

    return docs.select(whole_row(row), F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, schema)
