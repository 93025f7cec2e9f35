"""Spelling variants: PartEnum signatures of letter multisets, an equi-join on them, and verification by edit distance.

A word's letters are a binary vector: one dimension for each letter and each time it occurs. One inserted, deleted or replaced
letter changes at most two dimensions. The dimensions are dealt into ``PARTS`` parts; two words that differ in at most
``CHANGES`` dimensions agree wholly on some PARTS - CHANGES of them, so they share one of the signatures made for every such choice.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.joins import lookup_join
from ledgerloom.llm.shared import cut, partitions, written
from ledgerloom.llm.words import mix

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15

#: Parts that the dimensions are dealt into, and dimensions that one edit may change.
PARTS, CHANGES = 6, 2

#: The choices of parts that must agree, each a signature.
CHOICES = tuple(combinations(range(PARTS), PARTS - CHANGES))

#: Words of a signature that are compared two by two; those of a more common one are compared if they agree without one letter.
MOST_COMPARED = 64

#: Words of a place, a set of signatures that one task looks at together: on average, and at most. A fuller place is dealt anew.
PLACE_WORDS, MOST_PLACE_WORDS = 1 << 15, 1 << 20

#: Runs of letters; upper case A-Z is made lower case before they are taken.
RUN = "[a-z\\u00C0-\\u00FF]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code point, word, place in its word) of every letter."""
    length = np.array([len(w) for w in words], dtype=np.int64)
    code = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    word = np.repeat(np.arange(len(words)), length)
    return code, word, np.arange(len(code)) - (np.cumsum(length) - length)[word]


def signatures(words: list[str]) -> np.ndarray:
    """A row of 64-bit signatures for each word, one for each of CHOICES."""
    code, word, place = _letters(words)
    order = np.lexsort((code, word))
    code, word = code[order], word[order]
    new = np.ones(len(code), dtype=bool)
    new[1:] = (code[1:] != code[:-1]) | (word[1:] != word[:-1])
    # The how-manieth of its kind in the word: place in the sorted word less the place of the first.
    time = place - np.maximum.accumulate(np.where(new, np.arange(len(code)), 0)) + (np.arange(len(code)) - place)
    dimension = mix(code.astype(np.uint64) << _U(32) | time.astype(np.uint64))
    sums = np.zeros((len(words), PARTS), dtype=np.uint64)
    np.add.at(sums, (word, (code.astype(np.int64) + time) % PARTS), dimension)
    out = np.empty((len(words), len(CHOICES)), dtype=np.uint64)
    for k, choice in enumerate(CHOICES):
        key = np.full(len(words), k + 1, dtype=np.uint64)
        for part in choice:
            key = mix(key * _U(_ODD) + sums[:, part])
        out[:, k] = key
    return out


def without_one(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, 64-bit hash) of every word as it is and without each of its letters."""
    code, word, place = _letters(words)
    length = np.bincount(word, minlength=len(words))
    power = np.full(int(length.max(initial=0)) + 1, _ODD, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    term = mix(code.astype(np.uint64)) * power[place]
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(term, dtype=np.uint64)])
    end = np.cumsum(length)
    start = end - length
    whole = total[end] - total[start]
    head = total[:-1] - total[start[word]]
    tail = (total[end[word]] - total[1:]) * _U(pow(_ODD, -1, 1 << 64))
    every = np.concatenate([whole + length.astype(np.uint64), head + tail + (length[word] - 1).astype(np.uint64)])
    return np.concatenate([np.arange(len(words)), word]), mix(every)


def letter_runs(docs: DataFrame, *keep: Column, text: str = "text") -> DataFrame:
    """``run`` and the columns ``keep`` for every maximal run of letters of whole texts; null texts have none."""
    lower = F.translate(F.col(f"`{text}`").cast("string"), _UPPER, _LOWER)
    return docs.select(*keep, F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))


def vocabulary(words: DataFrame, *, word: str = "word", least_length: int = 5, least_count: int = 3) -> DataFrame:
    """``word, n`` of the different words of at least ``least_length`` code points that occur ``least_count`` times or more."""
    return words.where(F.length(word) >= least_length).groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def one_edit(a: str, b: str) -> bool:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    head = 0
    while head < len(a) and a[head] == b[head]:
        head += 1
    return a[head:] == b[head + 1 :] if len(a) < len(b) else head < len(a) and a[head + 1 :] == b[head + 1 :]


#: Code points of words that are compared side by side in arrays; longer ones are compared one by one.
_WIDTH = 32


def _one_edit(words: list[str], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """:func:`one_edit` of many pairs of places in ``words``."""
    code, word, place = _letters(words)
    length = np.bincount(word, minlength=len(words))
    wide = np.zeros((len(words), _WIDTH), dtype=np.uint32)
    short = place < _WIDTH
    wide[word[short], place[short]] = code[short]
    swap = length[left] > length[right]
    left, right = np.where(swap, right, left), np.where(swap, left, right)
    found = np.zeros(len(left), dtype=bool)
    for at in range(0, len(left), 1 << 16):
        i, j = left[at : at + (1 << 16)], right[at : at + (1 << 16)]
        grown = length[j] - length[i]
        a, b = wide[i], wide[j]
        differ = a != b
        same_length = (differ.sum(axis=1) == 1) & (grown == 0)
        head = np.where(differ.any(axis=1), differ.argmax(axis=1), _WIDTH)
        # One letter more: what follows the first difference is the same, one place on.
        rest = (a[:, :-1] != b[:, 1:]) & (np.arange(_WIDTH - 1) >= head[:, None])
        found[at : at + (1 << 16)] = same_length | ((grown == 1) & ~rest.any(axis=1) & (length[j] <= _WIDTH))
    for k in np.flatnonzero(np.maximum(length[left], length[right]) > _WIDTH):
        found[k] = one_edit(words[left[k]], words[right[k]])
    return found


def _within(group: np.ndarray, size: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places of equal ``group`` (sorted) in groups of at most ``most``, whose sizes are given."""
    left, right = [], []
    index = np.flatnonzero((size > 1) & (size <= most))
    step = 1
    while len(index):
        index = index[index + step < len(group)]
        index = index[group[index] == group[index + step]]
        left.append(index)
        right.append(index + step)
        step += 1
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _sized(key: np.ndarray) -> np.ndarray:
    """For sorted keys, how many are equal to each."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.append(first, len(key)))
    return np.repeat(size, size)


def _candidates(words: list[str], key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of words of equal key that one edit may part: all of a small group's, in larger ones those that agree without one letter."""
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    size = _sized(sorted_key)
    left, right = _within(sorted_key, size, MOST_COMPARED)
    left, right = order[left], order[right]
    large = order[size > MOST_COMPARED]
    if len(large):
        word, rest = without_one([words[k] for k in large])
        rest = mix(rest + key[large][word] * _U(_ODD))
        rows = np.unique(np.stack([rest, word.astype(np.uint64)], axis=1), axis=0)
        a, b = _within(rows[:, 0], _sized(rows[:, 0]), len(rows))
        pairs = np.unique(np.stack([large[rows[a, 1].astype(np.int64)], large[rows[b, 1].astype(np.int64)]], axis=1), axis=0)
        left, right = np.concatenate([left, pairs[:, 0]]), np.concatenate([right, pairs[:, 1]])
    return left, right


_zip, _unzip = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _packed(words: list[str], counts: np.ndarray) -> bytes:
    """Words in order with their counts; a signature follows from its word, so it is not sent."""
    order = sorted(range(len(words)), key=words.__getitem__)
    text = "\n".join(words[k] for k in order).encode()
    return _zip.compress(len(text).to_bytes(8, "little") + text + counts[order].astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(body: bytes) -> tuple[list[str], np.ndarray]:
    raw = _unzip.decompress(body)
    size = int.from_bytes(raw[:8], "little")
    numbers = np.frombuffer(raw, dtype=np.uint8, offset=8 + size)
    return raw[8 : 8 + size].decode().split("\n"), np.ascontiguousarray(numbers.reshape(8, -1).T).view("<i8").reshape(-1)


def _sent(words: DataFrame, shards: int) -> DataFrame:
    """``place, body``: the words of a batch for each place. A place is a choice of parts and a share of its signatures."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            keys = signatures(word)
            places, bodies = [], []
            for k in range(len(CHOICES)):
                shard = (keys[:, k] >> _U(16)) % _U(shards)
                order = np.argsort(shard, kind="stable")
                ends = np.flatnonzero(np.diff(shard[order], append=_U(shards)))
                for rows in np.split(order, ends[:-1] + 1):
                    places.append(int(shard[rows[0]]) * len(CHOICES) + k)
                    bodies.append(_packed([word[r] for r in rows], counts[rows]))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(bodies, pa.binary())], names=["place", "body"])

    return words.mapInArrow(send, "place long, body binary")


def _best(words: list[str], counts: np.ndarray, left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    """For every word of a pair: how many pairs it is in, and its partner of largest count, ties by code points."""
    one, other = np.concatenate([left, right]), np.concatenate([right, left])
    rank = np.empty(len(words), dtype=np.int64)
    rank[sorted(range(len(words)), key=lambda k: (-int(counts[k]), words[k]))] = np.arange(len(words))
    order = np.lexsort((rank[other], one))
    one, other = one[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1]])) if len(one) else np.zeros(0, dtype=np.int64)
    times = np.diff(np.append(first, len(one)))
    best = other[first]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[k] for k in one[first]], pa.string()), pa.array(times, pa.int64()), pa.array(-counts[best], pa.int64()), pa.array([words[k] for k in best], pa.string()), pa.nulls(len(first), pa.int64()), pa.nulls(len(first), pa.int64())],
        names=["word", "n_near", "less", "form", "choice", "n"],
    )


def _compared(sent: DataFrame, partitions: int) -> DataFrame:
    """Partial results ``word, n_near, less, form`` of every place, and (``word, choice, n``) of the words of places that are too full."""

    def verify(words: list[str], counts: np.ndarray, choice: int) -> pa.RecordBatch:
        keys = signatures(words)
        left, right = _candidates(words, keys[:, choice])
        near = _one_edit(words, left, right)
        left, right = left[near], right[near]
        # A pair counts where it first meets.
        first = (keys[left] == keys[right]).argmax(axis=1) == choice
        return _best(words, counts, left[first], right[first])

    def passed_on(words: list[str], counts: np.ndarray, choice: int) -> pa.RecordBatch:
        none = pa.nulls(len(words), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), none, none, pa.nulls(len(words), pa.string()), pa.array(np.full(len(words), choice), pa.int64()), pa.array(counts, pa.int64())],
            names=["word", "n_near", "less", "form", "choice", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, words, counts, full = None, [], [], False
        for batch in batches:
            for here, body in zip(batch.column("place").to_pylist(), batch.column("body"), strict=True):
                if here != place:
                    if words:
                        yield verify(words, np.concatenate(counts), place % len(CHOICES))
                    place, words, counts, full = here, [], [], False
                more, n = _unpacked(body.as_py())
                words += more
                counts.append(n)
                full = full or len(words) > MOST_PLACE_WORDS
                if full:
                    yield passed_on(words, np.concatenate(counts), place % len(CHOICES))
                    words, counts = [], []
        if words:
            yield verify(words, np.concatenate(counts), place % len(CHOICES))

    dealt = sent.repartition(partitions, "place").sortWithinPartitions("place")
    return dealt.mapInArrow(run, "word string, n_near long, less long, form string, choice long, n long")


def _by_rest(words: DataFrame) -> DataFrame:
    """``word, n_near, less, form`` of words (``word, n, choice``) that meet by a signature and what is left of them without one letter.

    So many different words can have one letter more than a given one: some hundred, whatever the data.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                word, choice = part.column("word").to_pylist(), part.column("choice").to_numpy()
                row, rest = without_one(word)
                key = mix(rest + signatures(word)[np.arange(len(word)), choice][row] * _U(_ODD))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *(part.column(c).take(row) for c in ("word", "n", "choice"))], names=["key", "word", "n", "choice"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = signatures(batch.column("word").to_pylist()) == signatures(batch.column("other").to_pylist())
                yield batch.filter(pa.array(same.argmax(axis=1) == batch.column("choice").to_numpy()))

    rows = words.mapInArrow(keyed, "key long, word string, n long, choice long").distinct()
    near = (F.col("word") < F.col("other")) & (F.abs(F.length("word") - F.length("other")) <= 1) & (F.levenshtein("word", "other", 1) == 1)
    pairs = rows.join(rows.withColumnsRenamed({"word": "other", "n": "other_n"}), ["key", "choice"]).where(near).select("word", "n", "other", "other_n", "choice").distinct()
    pairs = pairs.mapInArrow(first, pairs.schema)
    both = pairs.select("word", "other", "other_n").unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return both.select("word", F.lit(1).cast("long").alias("n_near"), (-F.col("other_n")).alias("less"), F.col("other").alias("form"))


def nearest(words: DataFrame) -> DataFrame:
    """``word, n_near, less, form`` of every word (``word, n``, each once) that has one an edit away: how many, and the best one with its n negated.

    Words are sent, packed, to a place for each of their signatures; a task compares the words of equal signatures of a
    place, so pairs are not shuffled. A place of more than ``MOST_PLACE_WORDS`` words passes them on as they come, unread, to be dealt by a
    finer key; so a task's memory is bounded whatever the words are, and no pair is lost.
    """
    spark = words.sparkSession
    shards = max(1, -(-words.count() // PLACE_WORDS))
    found = written(_compared(_sent(words, shards), max(partitions(spark), shards)), "near_words")
    again = _by_rest(found.where("choice is not null").select("word", "n", "choice"))
    every = found.where("choice is null").select("word", "n_near", "less", "form").unionByName(again)
    return every.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best")).select("word", "n_near", "best")


def variant_groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words`` (``word, n``; words once each, rows with a null word are left out).

    ``form`` is the near word of largest n, ties by code points, if that is at least twice the word's n, else null; ``root``
    is the last of the chain of forms. Counts at least double along a chain, so it ends, and its length is at most the
    number of bits of a count; chains are followed by doubling. Every step is a join on words: nothing is gathered.
    """
    words = written(words.where("word is not null").select("word", F.col("n").cast("long").alias("n")), "words")
    best = nearest(words)
    enough = -F.col("best.less") >= 2 * F.col("n")
    formed = cut(
        words.join(best, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    up = formed.where("form is not null").select("word", F.col("form").alias("up"))
    while True:
        step = cut(lookup_join(up, up.select(F.col("word").alias("up"), F.col("up").alias("further")), ["up"], "left").select("word", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")))
        up = step.select("word", "up")
        if step.where("moved").isEmpty():
            break
    return formed.join(up, "word", "left").select("word", "form", F.coalesce("up", "word").alias("root"), "n", "n_near", "form_n")
