"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column, without a Python string per word.

A word's hash is the sum of its bytes' random numbers, each multiplied by a power of an odd constant, taken from
one running sum over the bytes and finished by a mixing step: 64 bits, equal for equal words in any text and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Spaces: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: One random number per byte; upper case A-Z has that of its lower case.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_BYTE[65:91] = _BYTE[97:123]

_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the constant and of its inverse for positions 0 to n."""
    have = _powers.get("up")
    if have is None or len(have) <= n:
        size = 1 << max(16, int(n + 1).bit_length())
        for name, base in (("up", _ODD), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """The words of some texts in order. ``first[d]`` to ``first[d + 1]`` are those of text d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word, A-Z read as a-z."""
        up, down = _power_tables(len(self.data))
        total = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[self.data] * up[: len(self.data)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and the n + 1 offsets of its texts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def split_words(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> Words:
    """Runs of bytes outside ``gap``; no run crosses from one text to the next."""
    n = len(data)
    inside = np.zeros(n + 2, dtype=bool)
    np.logical_not(gap[data], out=inside[1 : n + 1])
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (edge | ~inside[:-1]) & inside[1:])
    end = np.flatnonzero(inside[:-1] & (edge | ~inside[1:]))
    doc = np.searchsorted(offsets, start, side="right") - 1
    first = np.searchsorted(start, offsets)
    return Words(data, start, end, doc, first)


def slices(batch: pa.RecordBatch, text: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive pieces of about ``most`` text bytes; a longer text is a piece of its own."""
    if not batch.num_rows:
        return
    _, offsets = text_bytes(batch.column(text))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def shingles(words: Words, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every run of ``width`` words; a text of fewer words, but not none, has its whole sequence as one."""
    count = np.diff(words.first)
    many = len(hashes)
    padded = np.concatenate([hashes, np.zeros(width, dtype=np.uint64)])
    left = words.first[1:][words.doc] - np.arange(many)
    total = np.zeros(many, dtype=np.uint64)
    factor = 1
    for k in range(width):
        factor = factor * _ODD & _MASK
        total += np.where(left > k, padded[k : k + many] * np.uint64(factor), np.uint64(0))
    keep = (left >= width) | ((count[words.doc] < width) & (left == count[words.doc]))
    total += np.minimum(left, width).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    return words.doc[keep], mix(total[keep])
