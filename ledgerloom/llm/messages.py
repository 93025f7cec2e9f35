"""Messages between blocks of documents and shards of keys: sorted 64-bit keys as compressed differences, one row per pair of the two.

A block states its distinct keys once; a shard holds every statement about its keys, sums them in sorted arrays, and
answers each block about the keys it named. Both are of bounded size: blocks and shards grow in number with the data.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import zstandard

_pack = zstandard.ZstdCompressor(level=1)
_unpack = zstandard.ZstdDecompressor()


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers from 0 to 2^63 - 1, byte by byte, compressed: four bytes each where the largest needs no more, else eight."""
    wide = len(values) > 0 and int(values.max()) >> 32 > 0
    kind, size = ("<u8", 8) if wide else ("<u4", 4)
    return bytes([size]) + _pack.compress(values.astype(kind).view(np.uint8).reshape(-1, size).T.tobytes())


def unpack_numbers(body: bytes) -> np.ndarray:
    size = body[0]
    raw = np.frombuffer(_unpack.decompress(memoryview(body)[1:]), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view("<u8" if size == 8 else "<u4").reshape(-1)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit keys as differences, byte by byte, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _pack.compress(steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes())


def unpack_keys(body: bytes) -> np.ndarray:
    raw = np.frombuffer(_unpack.decompress(body), dtype=np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1), dtype=np.uint64)


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where each shard's keys begin in sorted ``keys``; shards are equal ranges of the key space. Has shards + 1 entries."""
    step = (1 << 64) // shards
    lows = np.array([k * step for k in range(shards)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, lows), len(keys))


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """(shard, its part of the sorted keys) for shards that have any."""
    bounds = shard_bounds(keys, shards)
    for k in np.flatnonzero(np.diff(bounds)):
        yield int(k), slice(int(bounds[k]), int(bounds[k + 1]))


class HashArray:
    """Sorted distinct keys with numbers, in memory-mapped files without a name, which the system removes with the last user."""

    def __init__(self, keys: np.ndarray, **numbers: np.ndarray) -> None:
        self.keys = self._mapped(keys)
        self.numbers = {name: self._mapped(v) for name, v in numbers.items()}

    @staticmethod
    def _mapped(values: np.ndarray) -> np.ndarray:
        if not len(values):
            return values
        with tempfile.TemporaryFile() as f:
            f.write(np.ascontiguousarray(values).data)
            f.flush()
            return np.memmap(f, dtype=values.dtype, mode="r", shape=values.shape)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """The place of each wanted key, or -1."""
        if not len(self.keys):
            return np.full(len(wanted), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)


def summed(keys: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their numbers (last axis: several numbers per key)."""
    every = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
    value = np.concatenate(numbers) if numbers else np.zeros(0, dtype=np.int64)
    if not len(every):
        return every, value.astype(np.int64)
    order = np.argsort(every, kind="stable")
    every, value = every[order], value[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(value, first, axis=0)
