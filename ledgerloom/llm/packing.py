"""Best-fit packing planned over the histogram of piece lengths; pieces take planned slots by their rank within a length."""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import cut, partitions, written
from ledgerloom.llm.token_counts import TOKENIZER, WordIds, encode_whole, parts_at_spaces

PIECE = "id {}, piece int, start long, length long, ids_crc32 long"
SLOT = "id {}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"

#: Characters of a text that are looked up at once.
_SEGMENT = 1 << 18


def _as_bytes(ids: list[int]) -> bytes:
    """Little-endian 32-bit ids; an array costs more to make than a word's few ids take to pack."""
    return struct.pack(f"<{len(ids)}I", *ids) if len(ids) < 64 else np.array(ids, dtype="<u4").tobytes()


def _segments(text: str) -> Iterator[str]:
    """The text in order, cut at spaces only."""
    at = 0
    while at < len(text):
        to = len(text) if len(text) - at <= _SEGMENT else text.find(" ", at + _SEGMENT)
        to = len(text) if to < 0 else to
        yield text[at:to]
        at = to


def token_pieces(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Each document's ids, then ``end_id``, cut into pieces of ``capacity``; the last may be shorter.

    Columns ``id, piece, start, length, ids_crc32`` (of little-endian 32-bit ids). A null or empty text is the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_word = WordIds(tokenizer, _as_bytes) if parts_at_spaces(tokenizer) else None
        end = _as_bytes([end_id])
        for batch in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            for k, value in enumerate(batch.column("body")):
                body = value.as_py() or ""
                if by_word:
                    ids = b"".join(chain.from_iterable(map(by_word.look_up, _segments(body)))) + end
                else:
                    ids = _as_bytes(encode_whole(tokenizer, body)[0]) + end
                for j, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    owner.append(k)
                    piece.append(j)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").cast("string").alias("body")).mapInArrow(run, PIECE.format(kind))


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Best fit, longest first, over counts of equal lengths.

    Sequences with the same content are one run. Rows, ordered by length and rank: length, first rank, first sequence,
    pieces per sequence, offset of the first. Taking a run whole at least halves its free space, and a length splits
    two runs at most, so there are at most about ``36 * capacity`` rows, however many pieces there are.
    """
    free: dict[int, list[tuple[int, int]]] = {}
    sizes: list[int] = []
    made = 0
    rows: list[tuple[int, int, int, int, int]] = []

    def add(space: int, first: int, n: int) -> None:
        if n and space:
            if space not in free:
                free[space] = []
                insort(sizes, space)
            free[space].append((first, n))

    for length in sorted((x for x, n in counts.items() if n), reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                space = sizes[at]
                first, n = free[space].pop()
                if not free[space]:
                    del free[space]
                    sizes.pop(at)
            else:
                space, first = capacity, made
                n = -(-left // (capacity // length))
                made += n
            per = space // length
            full = min(n, left // per)
            rest = min(per, left - full * per) if full < n else 0
            if full:
                rows.append((length, rank, first, per, capacity - space))
            if rest:
                rows.append((length, rank + full * per, first + full, rest, capacity - space))
            add(space - per * length, first, full)
            add(space - rest * length, first + full, 1 if rest else 0)
            add(space, first + full + (1 if rest else 0), n - full - (1 if rest else 0))
            rank += full * per + rest
            left -= full * per + rest
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


@lru_cache(maxsize=4)
def _plan_keys(shipped: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    rows = shipped.value
    return rows, rows[:, 0] * (1 << 48) + rows[:, 1]


def pack(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """A sequence and an offset for every piece (columns as of ``token_pieces``), in as few sequences as best fit finds.

    The histogram (at most ``capacity`` numbers) is planned on the driver and the plan, whose size the capacity bounds,
    is broadcast. Ranks within a length come from counts by (length, part), so that a length that a third
    of all pieces share is ranked in as many tasks as there are parts. No piece is left out; no pieces give no rows.
    """
    spark = pieces.sparkSession
    parted = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece", "start", "ids_crc32"), F.lit(4 * partitions(spark))).cast("int"))
    counts = cut(parted.groupBy("length", "part").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shipped = spark.sparkContext.broadcast(plan(histogram, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    local = Window.partitionBy("length", "part").orderBy("id", "piece", "ids_crc32")
    ranked = (
        parted.withColumn("local", F.row_number().over(local)).join(before, ["length", "part"])
        .select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local") - 1).alias("rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, keys = _plan_keys(shipped)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = rows[np.searchsorted(keys, length * (1 << 48) + rank, side="right") - 1] if len(rows) else rows
            step = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")), pa.array(row[:, 2] + step // row[:, 3]), pa.array(row[:, 4] + step % row[:, 3] * length)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, SLOT.format(pieces.schema["id"].dataType.simpleString()))


def pack_documents(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER, capacity: int = 4096) -> DataFrame:
    """Pieces of all documents with their places. The pieces are written once to the shared folder and read from there.

    Null and empty texts are one piece of one id; repeated rows and ids are packed each; other columns are not read.
    """
    return pack(written(token_pieces(docs, id_col=id_col, text=text, tokenizer=tokenizer, capacity=capacity), "pieces"), capacity)
