"""Runs of words that repeat with a period, found by internal pattern matching.

A run is a maximal stretch whose words equal those `period` places on, at least twice as long as its smallest period.
Documents of an Arrow batch are put one after the other, each with word numbers of its own, so nothing matches across
two documents. Then, for the whole row of numbers at once:

- prefix doubling gives the suffix array and, at every level k, the rank of the 2^k words from each place on. Places that
  are already alone are never sorted again. The ranks also answer longest common extensions, forwards and backwards.
- A run of period q holds, within its first q words, a dyadic block of m = 2^k words (starting at a multiple of m) with
  2m <= q < 4m, and holds it again q words on. So every block that occurs twice asks for its occurrences from 2m to 4m
  words on (blocks of 2 words: 1 to 7 on, for the short periods; runs have 12 words or more, which leaves room for
  those). The answers are range successors in a wavelet tree over the suffix array.
- Occurrences that overlap by half or more form a progression, whose step is the block's own period. It is read off from
  one extension. If the block lies in the same run of that step, longer distances are no smallest periods and are
  skipped; otherwise each member is a candidate period, like each occurrence alone.
- A candidate is extended to both sides. Of candidates with one start and end the smallest is the run's period.

A document of n words costs O(n log n) steps. Memory is about 100 bytes a word and 4 more for each doubling of its
longest repeat; a document is a row, so one worker holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recall_lens.llm.staging import small_batches
from recall_lens.llm.text import batch, texts_of

LEAST_WORDS = 12
#: Words searched together.
GROUP_WORDS = 1 << 17

_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("text", pa.string()),
    ]
)
_SPARK = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, text string"


class Ranks:
    """The rank of the 2^k words from every place on, for each level k until all differ, and the suffix array.

    A rank is the place of the first equal one in the suffix array, so the equal ones fill the places from there on.
    """

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        counts = np.bincount(ids)
        rank = (np.cumsum(counts) - counts)[ids].astype(np.int32)
        self.order = np.argsort(ids, kind="stable").astype(np.int32)
        self.levels = [rank]
        opened = self.order[counts[ids[self.order]] > 1]
        size = 1
        while len(opened):
            after = np.zeros(len(opened), np.int64)
            inside = opened < n - size
            after[inside] = rank[opened[inside] + size] + 1
            key = rank[opened].astype(np.int64) * (n + 2) + after
            by_key = np.argsort(key, kind="stable")
            key, opened = key[by_key], opened[by_key]
            at = np.arange(len(key))
            old = key // (n + 2)
            new_group = np.concatenate(([True], key[1:] != key[:-1]))
            first = np.maximum.accumulate(np.where(new_group, at, 0))
            first_old = np.maximum.accumulate(np.where(np.concatenate(([True], old[1:] != old[:-1])), at, 0))
            self.order[old + at - first_old] = opened
            rank = rank.copy()
            rank[opened] = old + first - first_old
            self.levels.append(rank)
            ends = np.concatenate((new_group[1:], [True]))
            opened = opened[~(new_group & ends)]
            size *= 2

    def forwards(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on (i < j) agree."""
        n, i, j, start = len(self.order), i.copy(), j.copy(), i
        for k in range(len(self.levels) - 1, -1, -1):
            step, rank = 1 << k, self.levels[k]
            same = (j + step <= n) & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)])
            i, j = i + step * same, j + step * same
        return i - start

    def backwards(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j (i < j) agree."""
        i, j, start = i.copy(), j.copy(), i
        for k in range(len(self.levels) - 1, -1, -1):
            step, rank = 1 << k, self.levels[k]
            same = (i >= step) & (rank[np.maximum(i - step, 0)] == rank[np.maximum(j - step, 0)])
            i, j = i - step * same, j - step * same
        return start - i


class WaveletTree:
    """Numbers in a given order, level by level of their bits; each level keeps how many zero bits come before a place."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(int(values.max()).bit_length(), 1) if len(values) else 1
        self.zeros: list[np.ndarray] = []
        for h in range(self.bits - 1, -1, -1):
            bit = (values >> h) & 1 == 1
            self.zeros.append(np.concatenate(([0], np.cumsum(~bit))).astype(np.int32))
            values = np.concatenate((values[~bit], values[bit]))

    def less(self, left: np.ndarray, right: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many numbers of the places [left, right) are less than x."""
        total = np.zeros(len(x), np.int64)
        for zeros, h in zip(self.zeros, range(self.bits - 1, -1, -1), strict=True):
            zl, zr, one = zeros[left], zeros[right], (x >> h) & 1 == 1
            total += np.where(one, zr - zl, 0)
            left, right = np.where(one, zeros[-1] + left - zl, zl), np.where(one, zeros[-1] + right - zr, zr)
        return np.where(x >> self.bits > 0, -1, total)

    def smallest(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the numbers of the places [left, right)."""
        value = np.zeros(len(k), np.int64)
        for zeros in self.zeros:
            zl, zr = zeros[left], zeros[right]
            one = k >= zr - zl
            k = np.where(one, k - (zr - zl), k)
            value = value * 2 + one
            left, right = np.where(one, zeros[-1] + left - zl, zl), np.where(one, zeros[-1] + right - zr, zr)
        return value

    def successor(self, left: np.ndarray, right: np.ndarray, x: np.ndarray, none: int) -> np.ndarray:
        """The smallest number of the places [left, right) that is x or more, `none` where there is none."""
        out = np.full(len(x), none, np.int64)
        k = self.less(left, right, x)
        some = np.flatnonzero((k >= 0) & (k < right - left))
        out[some] = self.smallest(left[some], right[some], k[some])
        return out


def _candidates(ranks: Ranks, level: int, tree: WaveletTree, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (block, later occurrence) whose distance may be the period of a run, for the blocks of 2^level words."""
    n, m, rank = len(ranks.order), 1 << level, ranks.levels[level]
    b = np.arange(0, n - m + 1, m)
    size = np.bincount(rank, minlength=n)[rank[b]]
    b, size = b[size > 1], size[size > 1]
    left = places[rank[b]]
    right = left + size
    x, top = b + (1 if m == 2 else 2 * m), np.minimum(b + (8 if m == 2 else 4 * m), n)
    v = tree.successor(left, right, x, n)
    while True:
        live = v < top
        b, left, right, top, v = b[live], left[live], right[live], top[live], v[live]
        if not len(b):
            return
        after = tree.successor(left, right, v + 1, n)
        step = after - v
        chain = np.flatnonzero((after < top) & (step <= m // 2))
        yield b, v
        if len(chain):
            cb, cv, p = b[chain], v[chain], step[chain]
            last = np.minimum(cv + p + ranks.forwards(cv, cv + p) - m, top[chain] - 1)
            members = (last - cv) // p + 1
            one_run = cb + p + ranks.forwards(cb, cb + p) >= cv + m
            wide = np.flatnonzero(~one_run)
            times = np.maximum(members[wide] - 1, 0)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + 1
            yield np.repeat(cb[wide], times), np.repeat(cv[wide], times) + nth * np.repeat(p[wide], times)
            after[chain] = tree.successor(left[chain], right[chain], cv + (members - 1) * p + 1, n)
        v = after


def find(ids: np.ndarray, least: int = LEAST_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and smallest periods of all runs of `least` words or more, by start, then period."""
    found: list[np.ndarray] = []
    if len(ids):
        ranks = Ranks(ids)
        if len(ranks.levels) > 2:
            pairs = ranks.levels[1]
            counts = np.bincount(pairs, minlength=len(ids))
            kept = counts[pairs[ranks.order]] > 1
            tree = WaveletTree(ranks.order[kept].astype(np.int64))
            places = np.cumsum(kept) - kept
            for level in range(1, len(ranks.levels) - 1):
                for b, v in _candidates(ranks, level, tree, places):
                    back = ranks.backwards(b, v)
                    length = back + (v - b) + ranks.forwards(b, v)
                    good = length >= np.maximum(least, 2 * (v - b))
                    found.append(np.stack((b - back, length, v - b), 1)[good])
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.concatenate(([True], np.any(runs[1:, :2] != runs[:-1, :2], axis=1)))]
        runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


class _Numbers(dict):
    """Numbers of words, in order of coming, from `first` on."""

    def __init__(self, first: int) -> None:
        self.first = first

    def __missing__(self, word: bytes) -> int:
        self[word] = value = self.first + len(self)
        return value


def _groups(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """The words of consecutive texts, about GROUP_WORDS together; a longer text is a group of its own."""
    group: list[list[bytes]] = []
    total = 0
    for text in texts:
        words = text.split()
        if group and total + len(words) > GROUP_WORDS:
            yield group
            group, total = [], 0
        group.append(words)
        total += len(words)
    if group:
        yield group


def _collapsed(lists: list[list[bytes]], least: int) -> Iterator[tuple[list[dict[str, int]], bytes]]:
    """For the words of each document: its runs, and its text with each run cut to its first period."""
    ends = np.cumsum([len(words) for words in lists])
    ids = np.empty(ends[-1], np.int64)
    first, at = 0, 0
    for words in lists:
        numbers = _Numbers(first)
        ids[at : at + len(words)] = list(map(numbers.__getitem__, words))
        first, at = first + len(numbers), at + len(words)
    start, length, period = find(ids, least)
    change = np.zeros(len(ids) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    bounds = np.searchsorted(start, np.concatenate(([0], ends)))
    for k, words in enumerate(lists):
        low, high, base = bounds[k], bounds[k + 1], ends[k] - len(words)
        if low == high:
            yield [], b" ".join(words)
            continue
        runs = zip((start[low:high] - base).tolist(), length[low:high].tolist(), period[low:high].tolist(), strict=True)
        yield [{"start": s, "length": n, "period": q} for s, n, q in runs], b" ".join(compress(words, kept[base : ends[k]]))


def find_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_words, runs (start, length and smallest period in words, by start, then period) and text (single-spaced,
    without the words that a run repeats after its first period) of every row of `docs` (doc_id, text).

    Runs of fewer than `least` words (12 at least, which the search of short periods needs) are left out. A null or empty
    text has no word and no run, and its text is empty. A row comes out for every row that goes in, repeated ones and
    those without a doc_id included; other columns, whatever their names, are not read.
    """
    if least < LEAST_WORDS:
        raise ValueError(f"least is {least}; short periods are only found in runs of {LEAST_WORDS} words or more")
    small_batches(docs.sparkSession)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            doc_ids, done = rows.column(0), 0
            for lists in _groups(texts_of(rows.column(1))):
                found = list(_collapsed(lists, least))
                runs, texts = zip(*found, strict=True)
                yield batch(_ARROW, [doc_ids.slice(done, len(lists)), [len(w) for w in lists], list(runs), [t.decode() for t in texts]])
                done += len(lists)

    return docs.select("doc_id", "text").mapInArrow(search, _SPARK)
