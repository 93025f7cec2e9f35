"""Toxicity: a weighted lexicon learned from labels, matched by Aho-Corasick in folded text, less exception phrases."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.samples import MOST_ROWS, fit_logistic, labelled
from ledgerloom.llm.shared import whole_row

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ɑ": "a",
}
#: Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}

_GLYPHS = str.maketrans(HOMOGLYPHS)
_DIGITS = str.maketrans(SUBSTITUTES)
_MIXED = re.compile(r"(?<![^\W_])(?:[0134578@$][^\W\d_]|[^\W\d_]+[0134578@$!]+[^\W\d_])[^\W_]*(?:[0134578@$!]+[^\W\d_]+)*")
_GAPS = re.compile(r"[\W\d_]+")
#: Runs of letters and substitutes: digits anywhere, signs before a letter or digit, an exclamation mark only inside.
_RUN = re.compile(r"(?<![@$])[@$]*+(?:[^\W\d_]|[0134578])++(?:[@$!]++(?:[^\W\d_]|[0134578])++)*+")
_LETTER = re.compile(r"[^\W\d_]")
_SIGNS = re.compile(r"[0134578@$!][^\W\d_]|[^\W\d_][0134578]")
#: Invisible characters that split words.
_HIDDEN = re.compile("[­​-‏⁠﻿]")

MEASURES = ("weight", "density", "hits", "words")


def _read(run: re.Match) -> str:
    """A run of letters and substitutes as letters; with the run itself after it if it may be a number with a unit or a version."""
    word = run[0]
    letters = word.translate(_DIGITS)
    if letters == word or not _LETTER.search(word):
        return word
    return letters if _MIXED.fullmatch(word) else f"{letters} {word}"


def fold(text: str | None) -> str:
    """Words in lower case, look-alikes and digits inside words read as the letters they stand for, single spaces around."""
    body = text or ""
    if not body.isascii():
        body = _HIDDEN.sub("", unicodedata.normalize("NFKC", body))
    body = body.lower()
    if not body.isascii():
        body = body.translate(_GLYPHS)
    if _SIGNS.search(body):
        body = _RUN.sub(_read, body)
    return " " + _GAPS.sub(" ", body).strip() + " "


@dataclass
class Lexicon:
    """Weights of terms (" word " or, for words that begin so, " beginning"), benign phrases, and the calibration."""

    terms: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    weights: np.ndarray | None = None


class Matcher:
    def __init__(self, lexicon: Lexicon) -> None:
        self.terms = ahocorasick.Automaton()
        for term, weight in lexicon.terms.items():
            self.terms.add_word(term, (len(term), weight))
        self.phrases = ahocorasick.Automaton()
        for phrase in lexicon.exceptions:
            self.phrases.add_word(phrase, len(phrase))
        for a in (self.terms, self.phrases):
            if len(a):
                a.make_automaton()

    def words(self, folded: str) -> dict[int, float]:
        """The start of each matching word, with its heaviest term's weight, without those in an exception phrase."""
        best: dict[int, float] = {}
        if len(self.terms):
            for last, (length, weight) in self.terms.iter(folded):
                start = last - length + 1
                if weight > best.get(start, -1e9):
                    best[start] = weight
        if best and len(self.phrases):
            for last, length in self.phrases.iter(folded):
                for start in [s for s in best if last - length + 1 <= s < last]:
                    del best[start]
        return best

    def measures(self, text: str | None) -> tuple[float, float, float, float]:
        """Summed weight, the same per root of the words, matching words, and the text's words."""
        folded = fold(text)
        n = folded.count(" ") - 1 if folded.strip() else 0
        found = self.words(folded)
        total = sum(found.values())
        return total, total / max(1.0, n**0.5), float(len(found)), float(n)


def _calibration_input(m: np.ndarray) -> np.ndarray:
    weight, density, hits, words = m.T
    return np.column_stack([np.log1p(np.maximum(weight, 0)), np.log1p(np.maximum(density, 0)), np.log1p(hits), np.log1p(hits / np.maximum(words, 1) * 100), hits > 0])


@lru_cache(maxsize=4)
def _matcher(shipped: Broadcast) -> Matcher:
    return Matcher(shipped.value)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic and other documents with it) summed over the batches of a task."""
    pos: Counter[str] = Counter()
    neg: Counter[str] = Counter()
    for batch in batches:
        for value, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
            (pos if label else neg).update(set(fold(value.as_py()).split()))
        if len(pos) + len(neg) > 400_000:
            yield _word_rows(pos, neg)
            pos, neg = Counter(), Counter()
    yield _word_rows(pos, neg)


def _word_rows(pos: Counter[str], neg: Counter[str]) -> pa.RecordBatch:
    words = list(pos.keys() | neg.keys())
    return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([pos[w] for w in words], pa.int64()), pa.array([neg[w] for w in words], pa.int64())], names=["word", "pos", "neg"])


def learn_terms(sample: DataFrame, *, least: int = 3, shortest: int = 4, longest: int = 9, margin: float = 2.0, most_terms: int = 5_000) -> dict[str, float]:
    """Terms that mark toxic documents: whole words and beginnings of ``shortest`` to ``longest`` letters.

    A term's weight is its smoothed log-odds; terms in at least ``least`` toxic documents whose weight is over ``margin`` are
    kept, at most the ``most_terms`` with the largest sum of weights over the toxic documents: the lexicon's size.
    """
    words = sample.select("text", "label").mapInArrow(_count_words, "word string, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    p, n = sizes.get(1, 0), sizes.get(0, 0)
    beginnings = F.transform(F.sequence(F.lit(shortest), F.least(F.lit(longest), F.length("word"))), lambda k: F.concat(F.lit(" "), F.substring(F.col("word"), F.lit(1), k)))
    forms = F.when(F.length("word") >= shortest, F.concat(F.array(F.concat(F.lit(" "), "word", F.lit(" "))), beginnings)).otherwise(F.array(F.concat(F.lit(" "), "word", F.lit(" "))))
    weight = F.log((F.col("pos") + 0.5) / (p + 1.0)) - F.log((F.col("neg") + 0.5) / (n + 1.0))
    terms = (
        words.select(F.explode(forms).alias("term"), "pos", "neg").groupBy("term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") >= least).withColumn("weight", weight).where(F.col("weight") > margin)
        .orderBy((F.col("weight") * F.col("pos")).desc(), "term").limit(most_terms)
    )
    return {r["term"]: r["weight"] for r in terms.collect()}


def learn_exceptions(sample: DataFrame, lexicon: Lexicon, *, least: int = 5, share: float = 0.2, most: int = 2_000) -> list[str]:
    """Pairs of neighbouring words with a term in them that stand in other documents: toxic in under ``share`` of ``least`` or more."""
    shipped = sample.sparkSession.sparkContext.broadcast(lexicon)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(shipped)
        pos: Counter[str] = Counter()
        neg: Counter[str] = Counter()
        for batch in batches:
            for value, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
                folded = fold(value.as_py())
                seen = set()
                for start in matcher.words(folded):
                    end = folded.index(" ", start + 1)
                    before = folded.rfind(" ", 0, start)
                    if before >= 0:
                        seen.add(folded[before : end + 1])
                    after = folded.find(" ", end + 1)
                    if after >= 0:
                        seen.add(folded[start : after + 1])
                (pos if label else neg).update(seen)
        yield _word_rows(pos, neg)

    found = (
        sample.select("text", "label").mapInArrow(pairs, "word string, pos long, neg long").groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where((F.col("pos") + F.col("neg") >= least) & (F.col("pos") < share * (F.col("pos") + F.col("neg")))).orderBy(F.col("neg").desc(), "word").limit(most)
    )
    return [r["word"] for r in found.collect()]


def fit(docs: DataFrame, labels: DataFrame, train: Column, *, id_col: str = "doc_id", text: str = "text", label: str = "toxic", most_rows: int = MOST_ROWS) -> Lexicon:
    """A lexicon from at most ``most_rows`` labelled documents: terms and exceptions from three folds, calibration from the fourth.

    With no toxic or no other labelled document there are no terms, and every score is the share of toxic ones.
    """
    sample = labelled(docs, labels, train, id_col=id_col, text=text, label=label, most_rows=most_rows)
    learning = sample.where("fold <> 3")
    lexicon = Lexicon(learn_terms(learning))
    lexicon.exceptions = learn_exceptions(learning, lexicon)
    known = measured(sample, lexicon, keep=["label", "fold"]).select(*[F.col(m) for m in MEASURES], "row.label", "row.fold").toPandas()
    part = known[known["fold"] == 3] if known[known["fold"] == 3]["label"].nunique() == 2 else known
    x, y = _calibration_input(part[list(MEASURES)].to_numpy(float)), part["label"].to_numpy(float)
    lexicon.weights = fit_logistic(x, y) if len(y) else np.zeros(6)
    return lexicon


def measured(docs: DataFrame, lexicon: Lexicon, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``keep``, all by default), the ``MEASURES`` and the calibrated ``score`` of each whole text."""
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon)
    row = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    schema = T.StructType([T.StructField("row", row.schema), *[T.StructField(m, T.DoubleType()) for m in (*MEASURES, "score")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, weights = _matcher(shipped), shipped.value.weights
        for batch in batches:
            m = np.array([matcher.measures(v.as_py()) for v in batch.column("body")]).reshape(-1, 4)
            x = _calibration_input(m)
            score = 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ weights, -30, 30))) if weights is not None else np.zeros(len(m))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[pa.array(c) for c in (*m.T, score)]], names=["row", *MEASURES, "score"])

    return docs.select(whole_row(row), F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, **options: object) -> DataFrame:
    """Every whole text's score from 0 to 1. Null and empty texts have no words and no hits, and get the score of such; repeated
    rows get equal scores; columns of any name stay in ``row``."""
    return measured(docs, lexicon, **options)  # type: ignore[arg-type]
