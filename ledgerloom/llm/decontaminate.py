"""Benchmark decontamination: one Aho-Corasick automaton over normalised questions and answers, one pass over each text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import cut, whole_row

#: Bytes that are kept in a normalised text: digits, letters (A-Z as a-z) and all of UTF-8 beyond ASCII; others part words.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

SPAN = T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("word_from", T.LongType()), T.StructField("word_to", T.LongType()),
    T.StructField("char_from", T.LongType()), T.StructField("char_to", T.LongType()),
])


def normal_words(text: str | None) -> list[bytes]:
    """Words of a normalised text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()


def item_windows(text: str | None, width: int) -> set[str]:
    """Windows of ``width`` words of an item as patterns; an item of fewer words, but not none, is one window."""
    words = normal_words(text)
    runs = [words[i : i + width] for i in range(max(1, len(words) - width + 1))] if words else []
    return {" " + b" ".join(run).decode() + " " for run in runs}


@lru_cache(maxsize=4)
def _automaton(items: Broadcast) -> tuple[ahocorasick.Automaton, list[tuple[int, list[str]]]]:
    """The automaton of a broadcast block of items, built once per Python worker."""
    width, rows = items.value
    owners: dict[str, set[str]] = {}
    for item, text in rows:
        for window in item_windows(text, width):
            owners.setdefault(window, set()).add(item)
    found = ahocorasick.Automaton()
    known = []
    for window, names in owners.items():
        found.add_word(window, len(known))
        known.append((len(window), sorted(names)))
    if known:
        found.make_automaton()
    return found, known


def scan_text(text: str | None, found: ahocorasick.Automaton, known: list[tuple[int, list[str]]]) -> tuple[int, list[tuple[str, int, int, int, int]]]:
    """(number of words, spans). A span: item, its words [from, to) and its characters [from, to) in the original text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(NORMAL).split()
    if not words or not known:
        return len(words), []
    line = " " + b" ".join(words).decode() + " "
    hits = list(found.iter(line))
    if not hits:
        return len(words), []
    space = np.cumsum(np.frombuffer(line.encode("utf-32-le"), dtype=np.uint32) == 32)
    # The words' places in the original: runs of kept bytes, counted in characters.
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.concatenate([[False], np.frombuffer(NORMAL, dtype=np.uint8)[data] != 32, [False]])
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    start = chars[np.flatnonzero(inside[1:] & ~inside[:-1])]
    end = chars[np.flatnonzero(inside[:-1] & ~inside[1:])]
    spans = []
    for last, window in hits:
        length, names = known[window]
        a, b = int(space[last - length + 1]) - 1, int(space[last]) - 1
        spans += [(name, a, b, int(start[a]), int(end[b - 1])) for name in names]
    return len(words), spans


def _joined(spans: list[tuple[str, int, int, int, int]]) -> list[dict]:
    """Spans of one item that touch or overlap become one."""
    out: list[list] = []
    for item, a, b, x, y in sorted(spans):
        if out and out[-1][0] == item and a <= out[-1][2]:
            out[-1][2], out[-1][4] = max(b, out[-1][2]), max(y, out[-1][4])
        else:
            out.append([item, a, b, x, y])
    return [dict(zip(SPAN.names, x, strict=True)) for x in out]


def find_passages(
    docs: DataFrame, items: DataFrame, *, text: str = "text", keep: list[str] | None = None, item_id: str = "item_id",
    item_text: str = "text", width: int = 10, block_chars: int = 4_000_000,
) -> DataFrame:
    """Where items' windows of ``width`` words occur in the texts.

    Returns ``row`` (a struct of the columns ``keep`` of ``docs``, all by default), ``n_words`` and ``spans``: per item,
    merged runs of words and their character offsets in the original text. Words are digits, letters and all
    characters beyond ASCII, A-Z as a-z.

    Items go to the executors in blocks of about ``block_chars`` characters, one automaton each, so a benchmark
    of any size has a bounded broadcast; with more than one block the rows are checkpointed between passes.
    Null or empty texts and items have no words and no spans; repeated rows stay repeated; an item id given twice is
    one item with the windows of both; no items give no spans; other columns of any name are carried in ``row``.
    """
    spark = docs.sparkSession
    item = items.select(F.col(item_id).cast("string").alias("item_id"), F.col(item_text).alias("text")).where("item_id is not null and text is not null")
    total = item.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * total // block_chars)) if total > block_chars else 1
    row = docs.select(*[F.col(f"`{c}`") for c in keep or docs.columns])
    schema = T.StructType([
        T.StructField("row", row.schema), T.StructField("scanned", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)),
    ])
    out = docs.select(whole_row(row), F.col(f"`{text}`").cast("string").alias("scanned"), F.lit(0).cast("long").alias("n_words"), F.array().cast(T.ArrayType(SPAN)).alias("spans"))
    for k in range(blocks):
        part = item.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else item
        shipped = spark.sparkContext.broadcast((width, [(r.item_id, r.text) for r in part.toLocalIterator()]))
        last = k + 1 == blocks

        def scan(batches: Iterator[pa.RecordBatch], shipped: Broadcast = shipped, last: bool = last) -> Iterator[pa.RecordBatch]:
            found, known = _automaton(shipped)
            for batch in batches:
                counts, spans = [], []
                before = batch.column("spans").to_pylist()
                for value, old in zip(batch.column("scanned"), before, strict=True):
                    n, new = scan_text(value.as_py(), found, known)
                    counts.append(n)
                    spans.append(_joined([tuple(x.values()) for x in old or []] + new) if new else old)
                texts = pa.nulls(batch.num_rows, batch.column("scanned").type) if last else batch.column("scanned")
                yield pa.RecordBatch.from_arrays([batch.column("row"), texts, pa.array(counts, pa.int64()), pa.array(spans, batch.column("spans").type)], schema=batch.schema)

        out = out.mapInArrow(scan, schema)
        if not last:
            out = cut(out)
    return out.drop("scanned")


def decontaminate(docs: DataFrame, items: DataFrame, *, text: str = "text", most_words: int = 0, width: int = 10) -> DataFrame:
    """``docs`` without those of which more than ``most_words`` words lie in passages of the items."""
    return find_passages(docs, items, text=text, width=width).where(covered_words(F.col("spans")) <= most_words).select("row.*")


def covered_words(spans: F.Column) -> F.Column:
    """Words inside at least one span."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["word_from"].alias("a"), s["word_to"].alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("at"))
    return F.aggregate(
        ordered, start,
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(s["a"], acc["at"]))).alias("n"), F.greatest(acc["at"], s["b"]).alias("at")),
        lambda acc: acc["n"],
    )


def items_digest(names: F.Column) -> F.Column:
    """SHA-256 of the names, sorted and joined with commas."""
    return F.sha2(F.array_join(F.array_sort(names), ",").cast("binary"), 256)


def sha256_of(names: list[str]) -> str:
    """The same digest in Python, for tests."""
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
