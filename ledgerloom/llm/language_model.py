"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by the workers that score.

The model is as large as the corpus makes it, so no task and no driver holds it whole. Blocks of documents name their
bigrams and counts; shards of the key space sum them in memory-mapped sorted arrays and tell each block the totals of
those it named. One block per bigram, the first that named it, then adds it to its two words' statistics, which are
summed and told in the same way. A block then maps the part of the model that its texts need, and scores them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.messages import HashArray, pack_keys, pack_numbers, shard_bounds, summed, unpack_keys, unpack_numbers
from ledgerloom.llm.shared import partitions
from ledgerloom.llm.words import mix, slices, split_words, text_bytes

_U = np.uint64
START, END = _U(0x5D8A1F0C3B297E46), _U(0x1E6F4A93C0D7528B)

#: Statistics of a word: training tokens; as a context: bigram tokens and bigrams seen once, twice, more often; as a
#: continuation: distinct contexts.
WORD_NUMBERS = 6
#: What shards add up over their keys: bigrams seen 1, 2, 3 and 4 times; tokens, distinct tokens, bigrams, and words with 1, 2, 3, 4 and
#: 3 or more contexts.
BIGRAM_STATS, WORD_STATS = 4, 8


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """A 64-bit key per bigram."""
    return mix(before * _U(0x9FB21C651E98DF25) + mix(word + _U(0xD1B54A32D192ED03)))


@dataclass
class Tokens:
    """Token hashes of a block's texts in order (each text's words, then the end), what stands before each, and its text."""

    word: np.ndarray
    before: np.ndarray
    doc: np.ndarray
    texts: int


def tokens_of(table: pa.Table) -> Tokens:
    word, before, doc, texts = [], [], [], 0
    for batch in table.select(["body"]).to_batches():
        for piece in slices(batch, "body"):
            words = split_words(*text_bytes(piece.column("body")))
            n = piece.num_rows
            index = np.arange(n)
            h = np.empty(len(words.doc) + n, dtype=np.uint64)
            h[np.arange(len(words.doc)) + words.doc] = words.hashes()
            h[words.first[1:] + index] = END
            b = np.concatenate([[START], h[:-1]])
            b[words.first[:-1] + index] = START
            word.append(h)
            before.append(b)
            doc.append(np.repeat(index, np.diff(words.first) + 1) + texts)
            texts += n
    none = np.zeros(0, dtype=np.uint64)
    return Tokens(np.concatenate([none, *word]), np.concatenate([none, *before]), np.concatenate([np.zeros(0, dtype=np.int64), *doc]), texts)


def _training(table: pa.Table, tokens: Tokens) -> np.ndarray:
    return table.column("train").to_numpy().astype(bool)[tokens.doc]


def _counted(keys: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, also of other texts, with their number in training texts."""
    return summed([keys], [train.astype(np.int64)])


def discounts(seen: np.ndarray) -> np.ndarray:
    """Discounts for counts of 0, 1, 2 and 3 or more, from the numbers of things seen 1, 2, 3 and 4 times."""
    t1, t2, t3, t4 = (float(x) for x in seen)
    if not (t1 and t2 and t3):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = t1 / (t1 + 2 * t2)
    return np.clip([0.0, 1 - 2 * y * t2 / t1, 2 - 3 * y * t3 / t2, 3 - 4 * y * t4 / t3], 0.0, [0.0, 1.0, 2.0, 3.0])


def bigram_probability(c: np.ndarray, before: np.ndarray, word: np.ndarray, d2: np.ndarray, d1: np.ndarray, stats: np.ndarray) -> np.ndarray:
    """Probability of each token. ``c``: the bigram's count; ``before``, ``word``: WORD_NUMBERS rows of the two words.

    Discounted counts, interpolated with discounted continuation counts, and these with a uniform distribution over
    the training words and one for all others.
    """
    _, vocabulary, bigrams, m1, m2, _, _, m3 = (float(x) for x in stats)
    uniform = 1.0 / (vocabulary + 1)
    if bigrams:
        cont = word[5]
        low = (cont - d1[np.minimum(cont, 3)]) / bigrams + (d1[1] * m1 + d1[2] * m2 + d1[3] * m3) / bigrams * uniform
    else:
        low = np.full(len(c), uniform)
    total = np.maximum(before[1], 1)
    weight = (d2[1] * before[2] + d2[2] * before[3] + d2[3] * before[4]) / total
    high = (c - d2[np.minimum(c, 3)]) / total + weight * low
    return np.where(before[1] > 0, high, low)


class BlockModel:
    """The part of the model that a block's texts need, as memory-mapped sorted hash arrays."""

    def __init__(self, tokens: Tokens, answers: pa.Table, shards: int) -> None:
        pairs = np.unique(pair_keys(tokens.before, tokens.word))
        words = _words_of(tokens)
        told = answers.to_pylist()
        self.pairs = HashArray(pairs, count=_aligned(pairs, told, "pair", 1, shards)[0] >> 1)
        self.words = HashArray(words, stats=np.ascontiguousarray(_aligned(words, told, "word", WORD_NUMBERS, shards).T))
        self.seen = np.sum([r["stats"] for r in told if r["kind"] == "pair"], axis=0)
        self.stats = np.sum([r["stats"] for r in told if r["kind"] == "word"], axis=0)

    def score(self, tokens: Tokens) -> dict[str, np.ndarray]:
        c = self.pairs.numbers["count"][self.pairs.find(pair_keys(tokens.before, tokens.word))]
        word = self.words.numbers["stats"][self.words.find(tokens.word)].T
        before = self.words.numbers["stats"][self.words.find(tokens.before)].T
        p = bigram_probability(c, before, word, discounts(self.seen), discounts(self.stats[3:7]), self.stats)
        n, v = float(self.stats[0]), float(self.stats[1])
        base = (word[0] + 0.5) / (n + 0.5 * (v + 1))
        sums = lambda x: np.bincount(tokens.doc, weights=x, minlength=tokens.texts)
        return {
            "n_tokens": np.bincount(tokens.doc, minlength=tokens.texts), "n_known": sums(word[0] > 0).astype(np.int64),
            "train_tokens": np.full(tokens.texts, int(n)), "base_score": sums(np.log10(base)), "score": sums(np.log10(p)),
        }


def _words_of(tokens: Tokens) -> np.ndarray:
    return np.unique(np.concatenate([tokens.word, [START]])) if len(tokens.word) else tokens.word


def _aligned(keys: np.ndarray, told: list[dict], kind: str, width: int, shards: int) -> np.ndarray:
    """Numbers (width rows) for the block's sorted keys, from the shards' answers, which are in the order of the keys."""
    out = np.zeros((width, len(keys)), dtype=np.int64)
    bounds = shard_bounds(keys, shards)
    for r in told:
        if r["kind"] == kind:
            a, b = bounds[r["shard"]], bounds[r["shard"] + 1]
            out[:, a:b] = unpack_numbers(r["numbers"]).reshape(width, -1)
    return out


def _named(kind: str, block: int, keys: np.ndarray, numbers: np.ndarray, shards: int) -> pa.Table:
    """A row for every shard, also if the block has none of its keys: the answer carries the shard's totals."""
    bounds = shard_bounds(keys, shards)
    spans = [slice(int(a), int(b)) for a, b in zip(bounds, bounds[1:], strict=False)]
    return pa.table({
        "shard": pa.array(range(shards), pa.int32()), "block": pa.array([block] * shards, pa.int32()),
        "keys": pa.array([pack_keys(keys[s]) for s in spans], pa.binary()), "numbers": pa.array([pack_numbers(numbers[:, s].reshape(-1)) for s in spans], pa.binary()),
    })


NAMED = "shard int, block int, keys binary, numbers binary"
ANSWER = "block int, shard int, kind string, numbers binary, stats array<long>"


def _answer_rows(table: pa.Table, kind: str, numbers: list[np.ndarray], stats: list[int]) -> pa.Table:
    n = table.num_rows
    return pa.table({
        "block": table.column("block"), "shard": table.column("shard"), "kind": pa.array([kind] * n), "numbers": pa.array([pack_numbers(x) for x in numbers], pa.binary()),
        "stats": pa.array([stats] * n, pa.list_(pa.int64())),
    })


def score_texts(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every whole text.

    Tokens are words between spaces (A-Z as a-z), then one end. The model learns from the rows for which ``train`` holds.
    ``score`` is its log10 probability of the text, ``base_score`` that of a smoothed unigram, ``n_known`` the tokens
    that training texts have. Null is empty: the end alone. Rows with equal or null ids are scored each; with no training rows
    every token has probability 1. Words are told apart by 64-bit hashes, bigrams too.
    """
    shards = partitions(docs.sparkSession)
    blocks = 2 * shards
    kind = docs.schema[id_col].dataType.simpleString()
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    texts = docs.select(
        F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("string")), F.lit(blocks)).cast("int").alias("block"), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(train, F.lit(False)).alias("train"), body.alias("body"),
    )

    def name_pairs(table: pa.Table) -> pa.Table:
        tokens = tokens_of(table)
        keys, counts = _counted(pair_keys(tokens.before, tokens.word), _training(table, tokens))
        return _named("pair", table.column("block")[0].as_py(), keys, counts.reshape(1, -1), shards)

    def answer_pairs(table: pa.Table) -> pa.Table:
        named = [unpack_keys(x.as_py()) for x in table.column("keys")]
        keys, counts = summed(named, [unpack_numbers(x.as_py()) for x in table.column("numbers")])
        model = HashArray(keys, count=counts)
        free = counts > 0
        numbers: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(named)
        for k in np.argsort(table.column("block").to_numpy(), kind="stable"):
            at = model.find(named[k])
            numbers[k] = model.numbers["count"][at] * 2 + free[at]
            free[at] = False
        return _answer_rows(table, "pair", numbers, [int(np.count_nonzero(counts == n)) for n in range(1, BIGRAM_STATS + 1)])

    def name_words(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens = tokens_of(left)
        words = _words_of(tokens)
        numbers = np.zeros((WORD_NUMBERS, len(words)), dtype=np.int64)
        train = _training(left, tokens)
        np.add.at(numbers[0], np.searchsorted(words, tokens.word[train]), 1)
        pairs, first = np.unique(pair_keys(tokens.before, tokens.word), return_index=True)
        told = _aligned(pairs, right.to_pylist(), "pair", 1, shards)[0]
        own = (told & 1).astype(bool)
        c, before, word = told[own] >> 1, np.searchsorted(words, tokens.before[first[own]]), np.searchsorted(words, tokens.word[first[own]])
        numbers[1] = np.bincount(before, weights=c, minlength=len(words)).astype(np.int64)
        for k, seen in ((2, c == 1), (3, c == 2), (4, c > 2)):
            numbers[k] = np.bincount(before[seen], minlength=len(words))
        numbers[5] = np.bincount(word, minlength=len(words))
        return _named("word", left.column("block")[0].as_py(), words, numbers, shards)

    def answer_words(table: pa.Table) -> pa.Table:
        named = [unpack_keys(x.as_py()) for x in table.column("keys")]
        keys, sums = summed(named, [unpack_numbers(x.as_py()).reshape(WORD_NUMBERS, -1).T for x in table.column("numbers")])
        sums = sums.reshape(-1, WORD_NUMBERS)
        model = HashArray(keys, stats=sums)
        count, cont = sums[:, 0], sums[:, 5]
        stats = [int(count.sum()), int(np.count_nonzero(count)), int(cont.sum()), *[int(np.count_nonzero(cont == n)) for n in range(1, 5)], int(np.count_nonzero(cont >= 3))]
        return _answer_rows(table, "word", [model.numbers["stats"][model.find(x)].T.reshape(-1) for x in named], stats)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        tokens = tokens_of(left)
        found = BlockModel(tokens, right, shards).score(tokens)
        return pa.table({"id": left.column("id"), **{k: pa.array(v) for k, v in found.items()}})

    by_block = texts.groupBy("block")
    pairs = by_block.applyInArrow(name_pairs, NAMED).groupBy("shard").applyInArrow(answer_pairs, ANSWER)
    words = by_block.cogroup(pairs.groupBy("block")).applyInArrow(name_words, NAMED).groupBy("shard").applyInArrow(answer_words, ANSWER)
    scored = by_block.cogroup(pairs.union(words).groupBy("block")).applyInArrow(
        score, f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
