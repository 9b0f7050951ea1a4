"""Counting quotient filters over packed word numbers, without loss.

A phrase's word numbers are packed side by side into two halves and permuted by a Feistel network, which can be undone.
The first bits of the result are the quotient, all others the remainder, so a filter holds every key in full. It keeps
the remainders sorted, how many each quotient has (in unary, two bits a key or so), and counters, which cost one bit where
the count is 1. Sorted filters are merged into one by adding the counts of equal keys.

A family of filters splits all keys by their first bits into 2^split ranges, one filter each, so that ranges can be sent
to different tasks.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from recall_lens.llm.text import mixed

_ROUNDS = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))
_HEAD = struct.Struct("<IB")


@dataclass(frozen=True)
class Keys:
    """How phrases of up to `words` (2 or 4) word numbers of `bits` bits become keys; 2^split ranges of keys."""

    bits: int
    words: int
    split: int

    def __post_init__(self) -> None:
        if self.half > 64 or self.split > self.half:
            raise ValueError(f"{self.words} numbers of {self.bits} bits in 2^{self.split} ranges do not fit a key")

    @property
    def half(self) -> int:
        return self.bits * self.words // 2

    @property
    def _mask(self) -> np.uint64:
        return np.uint64((1 << self.half) - 1)

    def _turned(self, x: np.ndarray, c: np.uint64) -> np.ndarray:
        return mixed(x + c) >> np.uint64(64 - self.half)

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The permuted keys, as two halves, of rows of word numbers; a number 0 stands for no word."""
        n = self.words // 2
        halves = []
        for columns in (range(n), range(n, 2 * n)):
            value = np.zeros(len(numbers), np.uint64)
            for c in columns:
                value = value << np.uint64(self.bits) | numbers[:, c].astype(np.uint64)
            halves.append(value)
        left, right = halves
        for c in _ROUNDS:
            left, right = right, left ^ self._turned(right, c)
        return left, right

    def numbers(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rows of word numbers that these keys were made of."""
        for c in reversed(_ROUNDS):
            left, right = right ^ self._turned(left, c), left
        n, one = self.words // 2, np.uint64((1 << self.bits) - 1)
        columns = [value >> np.uint64(self.bits * (n - 1 - i)) & one for value in (left, right) for i in range(n)]
        return np.stack(columns, 1).astype(np.int64)

    def order(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of the keys by size; sorted stretches, as in filters, are merged."""
        if 2 * self.half <= 64:
            return np.argsort(left << np.uint64(self.half) | right, kind="stable")
        return np.lexsort((right, left))

    def ranges(self, left: np.ndarray) -> np.ndarray:
        return left >> np.uint64(self.half - self.split) if self.split else np.zeros(len(left), np.uint64)


def counted(keys: Keys, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, their counts, and for each given key which of them it is."""
    order = keys.order(left, right)
    left, right = left[order], right[order]
    first = np.ones(len(left), bool)
    first[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
    which = np.empty(len(left), np.int64)
    which[order] = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    if counts is None:
        total = np.diff(starts, append=len(left))
    else:
        total = np.add.reduceat(counts[order], starts) if len(starts) else np.empty(0, np.int64)
    return left[first], right[first], total, which


def _low_bytes(values: np.ndarray, bits: int) -> bytes:
    """The `bits` low bits of each value, in as few whole bytes."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8].tobytes()


def _from_bytes(data: memoryview, n: int, bits: int) -> tuple[np.ndarray, int]:
    width = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64), n * width


def _write(keys: Keys, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
    """One filter: sorted distinct keys of one range, and their counts."""
    n = len(left)
    quotient_bits = min(max(n.bit_length() - 1, 0), keys.half - keys.split)
    rest = keys.half - keys.split - quotient_bits
    inside = left & np.uint64((1 << (keys.half - keys.split)) - 1) if keys.half > keys.split else np.zeros(n, np.uint64)
    quotient = (inside >> np.uint64(rest)).astype(np.int64) if rest < 64 else np.zeros(n, np.int64)
    per_quotient = np.bincount(quotient, minlength=1 << quotient_bits)
    unary = np.ones(n + len(per_quotient), np.uint8)
    unary[np.cumsum(per_quotient) + np.arange(len(per_quotient))] = 0
    low = inside & np.uint64((1 << rest) - 1)
    if rest + keys.half <= 64:
        remainder = _low_bytes(low << np.uint64(keys.half) | right if keys.half < 64 else right, rest + keys.half)
    else:
        remainder = _low_bytes(low, rest) + _low_bytes(right, keys.half)
    many = counts > 1
    more = counts[many] - 2
    parts = (
        _HEAD.pack(n, quotient_bits),
        np.packbits(unary).tobytes(),
        remainder,
        np.packbits(many).tobytes(),
        np.minimum(more, 255).astype(np.uint8).tobytes(),
        more[more >= 255].astype("<u8").tobytes(),
    )
    return b"".join(parts)


def read(keys: Keys, part: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The keys, in order, and counts of the filter of range `part`."""
    n, quotient_bits = _HEAD.unpack_from(data)
    view, at = memoryview(data), _HEAD.size
    rest = keys.half - keys.split - quotient_bits
    size = n + (1 << quotient_bits)
    unary = np.unpackbits(np.frombuffer(view[at:], np.uint8, (size + 7) // 8), count=size)
    at += (size + 7) // 8
    quotient = (np.cumsum(unary == 0)[unary == 1]).astype(np.uint64)
    if rest + keys.half <= 64:
        value, used = _from_bytes(view[at:], n, rest + keys.half)
        right = value & keys._mask
        low = value >> np.uint64(keys.half) if keys.half < 64 else np.zeros(n, np.uint64)
    else:
        low, used = _from_bytes(view[at:], n, rest)
        right, more = _from_bytes(view[at + used :], n, keys.half)
        used += more
    at += used
    many = np.unpackbits(np.frombuffer(view[at:], np.uint8, (n + 7) // 8), count=n).astype(bool)
    at += (n + 7) // 8
    more = np.frombuffer(view[at:], np.uint8, int(many.sum())).astype(np.int64)
    at += len(more)
    large = more == 255
    more[large] = np.frombuffer(view[at:], "<u8", int(large.sum())).astype(np.int64)
    counts = np.ones(n, np.int64)
    counts[many] = more + 2
    top = np.uint64(part) << np.uint64(keys.half - keys.split) if keys.split else np.uint64(0)
    left = top | (quotient << np.uint64(rest) if rest < 64 else np.uint64(0)) | low
    return left, right, counts


def write(keys: Keys, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(range, filter) of sorted distinct keys; ranges without a key have no filter."""
    parts, starts = np.unique(keys.ranges(left), return_index=True)
    for part, i, j in zip(parts.tolist(), starts, np.append(starts, len(left))[1:], strict=True):
        yield part, _write(keys, left[i:j], right[i:j], counts[i:j])


def merged(keys: Keys, part: int, filters: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys and counts of the filters of one range, and for each filter which of them its own keys are."""
    read_ = [read(keys, part, data) for data in filters]
    columns = [np.concatenate(c) for c in zip(*read_, strict=True)]
    left, right, counts, which = counted(keys, *columns)
    return left, right, counts, np.split(which, np.cumsum([len(r[0]) for r in read_])[:-1])
