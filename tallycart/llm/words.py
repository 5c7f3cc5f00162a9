"""Words, their hashes and rolling window hashes, for use inside tasks.

A word is a run of bytes other than the six ASCII white-space characters, which is
exactly what ``bytes.split`` without arguments gives.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The strings of an Arrow column as bytes."""
    return column.cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words, remembered. Forgets everything once it holds ``limit``."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


HASHES = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over their whole range (one to one)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of the base and of its inverse, as many as the longest text needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def first(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up))
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.cumprod(steps, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2**64, of every window of ``length`` words.

    A window's value is the difference of two prefix sums of hash times power of the
    base, shifted back to the window's start; then mixed.
    """
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    up, down = _Powers.first(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, dtype=np.uint64, out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * down[:n])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` successive values, by doubling."""
    if len(values) < width:
        return values[:0]
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed longs."""
    return values.view(np.int64)


def lists_of(arrays: Iterable[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from one array per row."""
    arrays = list(arrays)
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate(arrays) if arrays else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def pieces(batches: Iterable[pa.RecordBatch], most: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that what is built for one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)
