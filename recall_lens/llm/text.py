"""Words of texts and hashes of word runs, shared by the operators that run in Arrow functions.

A word is a run of bytes outside space and 0x09-0x0D, which is what bytes.split() gives.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of `size` words; empty where there are fewer words. `which` picks one of two
    independent multipliers, so that both together make 128 bits."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = _BASES[which]
    total, done, run, length = None, 0, mixed(words + np.uint64(which)), 1
    bits = size
    while bits:
        if bits & 1:  # `total` holds runs of `done` words; runs of `length` words follow it
            power = np.uint64(pow(base, length, 1 << 64))
            total = run[:n] if total is None else total[:n] * power + run[done : done + n]
            done += length
        bits >>= 1
        if bits:
            m = len(run) - length
            run = run[:m] * np.uint64(pow(base, length, 1 << 64)) + run[length : length + m]
            length *= 2
    return mixed(total)


def batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(columns, schema, strict=True)], schema=schema)
